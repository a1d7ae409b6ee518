"""Light stems of a token vocabulary, once per distinct token.

The light stemmer for Czech of Dolamic and Savoy ("Indexing and stemming approaches for the Czech language", 2009): a case
ending is taken off, then a possessive one; where an ending begins with a soft vowel, the consonants before it are put
back to their hard form. Everything is one conditional expression for each of the two steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published algorithm: endings by the fewest letters of a word that loses them, longest endings first.
# HARD: the ending goes. SOFT: all but its first letter goes and the rest is softened. BARE: it goes and the rest is softened.
HARD, SOFT, BARE = "hard", "soft", "bare"
CASES = (
    (8, HARD, ("atech",)),
    (7, SOFT, ("ětem",)),
    (7, HARD, ("atům",)),
    (6, SOFT, ("ech", "ich", "ích", "ého", "ěmi", "emi", "ému", "ete", "eti", "iho", "ího", "ími", "imu")),
    (6, HARD, ("ách", "ata", "aty", "ých", "ama", "ami", "ové", "ovi", "ými")),
    (5, SOFT, ("em",)),
    (5, BARE, ("es", "ém", "ím")),
    (5, HARD, ("ům", "at", "ám", "os", "us", "ým", "mi", "ou")),
    (4, SOFT, ("e", "i", "í", "ě")),
    (4, HARD, ("u", "y", "ů", "a", "o", "á", "é", "ý")),
)
POSSESSIVES = (
    (6, HARD, ("ov", "ův")),
    (6, SOFT, ("in",)),
)
#: What stands before a soft ending, and its hard form.
HARDENED = (("[cč][ei]", "k"), ("[zž][ei]", "h"), ("čt[ěií]", "ck"), ("št[ěií]", "sk"))


def _without(word: Column, letters: int) -> Column:
    return F.substr(word, F.lit(1), F.char_length(word) - letters)


def softened(word: Column) -> Column:
    """The word without its last letter, consonants before it in their hard form."""
    rules = reduce(lambda c, r: c.when(word.rlike(f"{r[0]}$"), F.regexp_replace(word, f"{r[0]}$", r[1])), HARDENED, F)
    return rules.otherwise(_without(word, 1))


def without_ending(word: Column, endings: tuple) -> Column:
    """The first of the rules that fits; the word itself if none does."""
    out = F
    for least, how, group in endings:
        size = len(group[0])
        cut = _without(word, size) if how == HARD else softened(_without(word, size - (how == SOFT)))
        out = out.when((F.char_length(word) >= least) & F.right(word, F.lit(size)).isin(*group), cut)
    return out.otherwise(word)


def stemmed(tokens: DataFrame, column: str = "token") -> DataFrame:
    """tokens with `stem`, in lower case. Tokens with anything but letters, digits and underscores stay as they are."""
    plain = F.col(column).rlike(r"^[\p{L}\p{M}\p{N}_]+$")
    rows = tokens.withColumn("stem", without_ending(F.lower(column), CASES))
    rows = rows.withColumn("stem", without_ending(F.col("stem"), POSSESSIVES))
    return rows.withColumn("stem", F.when(plain, F.col("stem")).otherwise(F.col(column)))
