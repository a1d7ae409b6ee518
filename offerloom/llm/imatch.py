"""Document fingerprints by I-Match, and fingerprints of edited texts.

Terms are runs of letters and digits in lower case. Terms whose inverse document frequency lies in a band form the lexicon. A
text keeps its distinct terms of the lexicon, sorted (as 64-bit hashes); hashes of what several randomised subsets of the
lexicon leave of them are its fingerprint. Subsets are random samples of the lexicon at falling rates, some for each rate,
so that both short and long texts have subsets in which few of their terms are left. The likeness of two fingerprints is
the largest share of equal hashes at one rate.

A term of the lexicon is in at least exp(-most_idf) of all texts, so the lexicon has at most exp(most_idf) times as many terms
as a text has on average, whatever the size of the corpus. It is sent out as a bitmap of 64 bits for each of its terms, on
which one in 64 other terms passes for a term of the lexicon.

Null text is the empty text. A text without lexicon terms is fingerprinted by all its terms; without any term its hashes
are all empty. Equal texts have equal fingerprints, and likeness 1. The next document is the next row by id, then by
text; the last row's next is the first. Null ids come first. Repeated rows are neighbours of each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import saved


@dataclass(frozen=True)
class Band:
    """The band of ln(documents / documents with the term) that makes a term part of the lexicon, and the subsets of it."""

    least_idf: float = 3.0
    most_idf: float = 6.2
    copies: int = 8
    rates: tuple[int, ...] = (2, 4, 6, 8)  # halvings


@dataclass(frozen=True)
class Lexicon:
    """A corpus' lexicon: a bitmap over `slots` places."""

    slots: int
    bits: bytes
    band: Band


#: One byte of the lexicon's bitmap holds so many places, so that it is also an ASCII character.
_PER_BYTE = 7
_BITS_EACH, _LEAST_SLOTS = 64, 1 << 14
#: At a rate, likeness counts at least so many subsets, so that one equal subset of very few isn't full likeness.
_LEAST_SUBSETS = 4
#: Rows of neighbouring ids are put in order together, about so many of them, in so many ranges at most.
_PER_RANGE, _MOST_RANGES = 256, 16_384


def terms_of(text: Column) -> Column:
    """Hashes of a text's distinct terms."""
    terms = F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")
    return F.transform(terms, lambda w: F.xxhash64(w))


def lexicon_of(docs: DataFrame, text: Column, band: Band = Band()) -> Lexicon:
    """The lexicon of a corpus. Only its terms' places come to the driver: their number doesn't grow with the corpus."""
    n = docs.count()
    df = docs.select(F.explode(terms_of(text)).alias("term")).groupBy("term").count()
    idf = F.log(F.lit(n) / F.col("count"))
    inside = saved(df.filter((idf >= band.least_idf) & (idf <= band.most_idf)).select("term"), "lexicon")
    slots, terms = _LEAST_SLOTS, inside.count()
    while slots < _BITS_EACH * terms:
        slots *= 2
    out = bytearray(math.ceil(slots / _PER_BYTE))
    for row in inside.select(F.pmod("term", F.lit(slots)).alias("at")).toLocalIterator():
        out[row["at"] // _PER_BYTE] |= 1 << row["at"] % _PER_BYTE
    return Lexicon(slots, bytes(out), band)


def fingerprint(text: Column, lexicon: Lexicon) -> Column:
    """Hashes of the lexicon's subsets, rate by rate, with commas between; '-' where a subset leaves no term."""
    known, band = F.lit(bytearray(lexicon.bits)), lexicon.band

    def inside(term: Column) -> Column:
        at = F.pmod(term, F.lit(lexicon.slots))
        byte = F.substring(known, F.floor(at / _PER_BYTE).cast("int") + 1, F.lit(1))
        return F.call_function("getbit", F.ascii(byte.cast("string")), (at % _PER_BYTE).cast("int")) == 1

    def kept(terms: Column) -> Column:
        """One array in an array, so that what is computed is bound once."""
        return F.transform(F.array(F.filter(terms, inside)), lambda k: F.array_sort(F.when(F.size(k) > 0, k).otherwise(terms)))

    def sampled(shift: int, mask: int) -> Callable[[Column], Column]:
        return lambda t: F.shiftright(t, shift).bitwiseAND(F.lit(mask)) == 0

    def subsets(terms: Column) -> Column:
        picks = [terms]
        for rate in band.rates:
            for copy in range(band.copies):
                picks.append(F.filter(terms, sampled(7 * copy, (1 << rate) - 1)))
        return F.array_join(F.transform(F.array(*picks), lambda p: F.when(F.size(p) == 0, F.lit("-")).otherwise(F.substring(F.hex(F.pmod(F.hash(p).cast("long"), F.lit(1 << 32)) + (1 << 32)), 2, 8))), ",")

    bound = F.transform(F.array(terms_of(text)), lambda t: F.get(F.transform(kept(t), subsets), F.lit(0)))
    return F.get(bound, F.lit(0))


def likeness(a: Column, b: Column, band: Band) -> Column:
    """0 to 1. Equal fingerprints: 1."""
    pairs = F.arrays_zip(F.split(a, ",").alias("a"), F.split(b, ",").alias("b"))
    shares = []
    for start, n in [(1, 1), *((2 + k * band.copies, band.copies) for k in range(len(band.rates)))]:
        told = F.filter(F.slice(pairs, start, n), lambda p: (p["a"] != "-") | (p["b"] != "-"))
        same = F.filter(told, lambda p: p["a"] == p["b"])
        shares.append(F.size(same) / F.greatest(F.size(told), F.lit(_LEAST_SUBSETS)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(*shares)).cast("double")


def range_ends(rows: DataFrame, id_col: str, per_range: int = _PER_RANGE) -> list:
    """Ids that cut the rows into ranges of about equal numbers of rows: quantiles over all ids."""
    n = rows.count()
    ranges = min(_MOST_RANGES, n // per_range)
    if ranges < 2:
        return []
    shares = F.array(*(F.lit(k / ranges) for k in range(1, ranges)))
    ends = rows.agg(F.percentile_approx(id_col, shares, F.lit(max(10_000, 4 * ranges))).alias("ends")).first()["ends"]
    return sorted(set(ends or []))


def with_next(rows: DataFrame, id_col: str, order: list[str], head: Callable[[DataFrame], DataFrame], carried: list[str], per_range: int = _PER_RANGE) -> DataFrame:
    """head(rows) with `next_<column>` for the carried columns: those of the next row by id, the first row's for the last.

    Ids are cut into ranges of about `per_range` rows by quantiles; a null id is in the first. Rows move once, to their range;
    each range's first row also goes to the last range before that has rows. head adds what is dear to compute: it is applied
    once to each row, and once more to the ranges' first rows.
    """
    ends = range_ends(rows, id_col, per_range)
    inner = range(0, len(ends), 128)

    def numbered(df: DataFrame) -> DataFrame:
        """The number of ends at or below the id, from every 128th and then from those in between."""
        if not ends:
            return df.withColumn("_range", F.lit(0).cast("long"))
        at = F.col(id_col)
        block = F.size(F.filter(F.lit([ends[k] for k in inner]), lambda e: e <= at)) - 1
        within = F.size(F.filter(F.get(F.array(*(F.lit(ends[k : k + 128]) for k in inner)), block), lambda e: e <= at))
        return df.withColumn("_range", F.when(at.isNull() | (block < 0), 0).otherwise(block * 128 + within).cast("long"))

    # a row for each range: its first id, and the range before it
    found = numbered(rows.select(id_col)).groupBy("_range").agg(F.min(id_col).alias("_first"), F.bool_or(F.col(id_col).isNull()).alias("_null")).orderBy("_range").collect()
    numbers = [r["_range"] for r in found]
    id_type = rows.schema[id_col].dataType.simpleString()
    of_range = rows.sparkSession.createDataFrame([(r["_range"], None if r["_null"] else r["_first"], b) for r, b in zip(found, numbers[-1:] + numbers[:-1])], f"_range long, _first {id_type}, _before long")
    firsts = numbered(rows).join(F.broadcast(of_range), "_range").filter(F.col(id_col).eqNullSafe(F.col("_first")))
    firsts = head(firsts.groupBy("_before").agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_before", "_row.*"))
    heads = firsts.select(F.col("_before").alias("_range"), *(F.col(c).alias(f"_head_{c}") for c in carried))

    inside = Window.partitionBy("_range").orderBy(*order)
    lead = head(numbered(rows)).withColumn("_lead", F.lead(F.struct(*carried)).over(inside)).join(heads, "_range", "left")
    nexts = {f"next_{c}": F.when(F.col("_lead").isNotNull(), F.col(f"_lead.{c}")).otherwise(F.col(f"_head_{c}")) for c in carried}
    return lead.select(*(c for c in lead.columns if not c.startswith(("_lead", "_head_")) and c != "_range"), *(v.alias(k) for k, v in nexts.items()))


def fingerprints(docs: DataFrame, band: Band = Band(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: length, hash of the edited text, both fingerprints and their likeness, likeness to the next.

    The edited text is the text with its last floor(length / 4) characters replaced by as many from the next text's start.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lexicon = lexicon_of(rows, F.col("text"), band)
    rows = with_next(rows, "id", ["id", "text"], lambda df: df.withColumn("fingerprint", fingerprint(F.col("text"), lexicon)), ["text", "fingerprint"])
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"), lexicon))
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), band).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), band).alias("near_next"),
    )
