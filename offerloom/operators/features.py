"""Features of offer-product pairs, as column expressions and joins, and their registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.operators import name_attributes


def shop_matches(shops: Column, shop: Column) -> Column:
    """How many of the product's shops are the offer's; 0 if the product has none."""
    return F.coalesce(F.size(F.filter(shops, lambda s: s == shop)), F.lit(0))


def ean_known(eans: Column, ean: Column) -> Column:
    return (F.coalesce(F.size(eans), F.lit(0)) > 0).cast("int") * ean.isNotNull().cast("int")


def ean_matches(eans: Column, ean: Column) -> Column:
    return F.coalesce(F.array_contains(eans, ean), F.lit(False)).cast("int")


def name_similarity(a: Column, b: Column) -> Column:
    """1.3 for equal token lists, 1.2 for equal tokens in another order, 1.1 for titles equal without spaces, else 0."""
    # titles of equal tokens are equally long, and token lists are only equal if titles are: most pairs aren't split or sorted
    ta, tb = F.array_sort(F.split(a, " ")), F.array_sort(F.split(b, " "))
    return F.when(a == b, 1.3).when((F.length(a) == F.length(b)) & (ta == tb), 1.2).when(F.replace(a, F.lit(" "), F.lit("")) == F.replace(b, F.lit(" "), F.lit("")), 1.1).otherwise(0.0)


def tokens_contained(a: Column, b: Column) -> Column:
    """All tokens of title a are tokens of title b."""
    return F.size(F.array_except(F.split(a, " "), F.split(b, " "))) == 0


def _chars(word: Column, start: Column | int, n: Column | int) -> Column:
    """n characters from place `start` on, counted from 0."""
    return F.substr(word, start + 1 if isinstance(start, Column) else F.lit(start + 1), n if isinstance(n, Column) else F.lit(n))


def _places(n: Column) -> Column:
    """0 .. n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _is_letter(char: Column) -> Column:
    return char.between("a", "z") & (F.char_length(char) == 1)


def one_edit_makes(word: Column, other: Column) -> Column:
    """`word` becomes `other` when a character is left out, two neighbours change places, or a letter from a to z is put in or
    stands for a character."""
    n, m = F.char_length(word), F.char_length(other)
    rest = lambda w, i: F.concat(_chars(w, 0, i), _chars(w, i + 1, F.char_length(w)))  # noqa: E731  w without the character at i
    left_out = (m == n - 1) & F.exists(_places(n), lambda i: rest(word, i) == other)
    put_in = (m == n + 1) & F.exists(_places(m), lambda i: _is_letter(_chars(other, i, 1)) & (rest(other, i) == word))
    replaced = F.exists(_places(n), lambda i: _is_letter(_chars(other, i, 1)) & (rest(word, i) == rest(other, i)))
    swapped = F.exists(_places(n - 1), lambda i: F.concat(_chars(word, 0, i), _chars(word, i + 1, 1), _chars(word, i, 1), _chars(word, i + 2, n)) == other)
    # Levenshtein's distance counts a swap as two
    return (F.abs(n - m) <= 1) & (word != other) & (F.levenshtein(word, other) <= 2) & (left_out | put_in | ((m == n) & (replaced | swapped)))


def contained_after_edit(a: Column, b: Column) -> Column:
    """All tokens of title a are tokens of some title that is one edit away from title b as a whole: a character left out, two
    neighbours swapped, a letter from a to z put in or in a character's place. Spaces are characters: two words may be joined,
    with or without a letter between them, or a letter may move from one word to the next.

    An edit touches one word, or two neighbours and the space between them, so a's tokens have to be among the others and what
    the edit makes of these."""
    ta, tb = F.split(a, " "), F.split(b, " ")
    n = F.size(tb)

    def missing(i: Column, words: int) -> Column:
        """a's tokens that aren't among b's without `words` of them from place i on."""
        return F.array_except(ta, F.concat(F.slice(tb, F.lit(1), i), F.slice(tb, i + 1 + words, n)))

    def by_word(i: Column) -> Column:
        lost = missing(i, 1)
        return (F.size(lost) == 1) & one_edit_makes(F.get(tb, i), F.get(lost, F.lit(0)))

    def by_space(i: Column) -> Column:
        lost, first, second = missing(i, 2), F.get(tb, i), F.get(tb, i + 1)
        only, x, y = F.get(lost, F.lit(0)), F.char_length(first), F.char_length(second)
        joined = (only == F.concat(first, second)) | ((F.char_length(only) == x + y + 1) & F.startswith(only, first) & F.endswith(only, second) & _is_letter(_chars(only, x, 1)))
        back = F.array(_chars(first, 0, x - 1), F.concat(_chars(first, x - 1, 1), second))
        on = F.array(F.concat(first, _chars(second, 0, 1)), _chars(second, 1, y))
        moved = ((x > 0) & (F.size(F.array_except(lost, back)) == 0)) | ((y > 0) & (F.size(F.array_except(lost, on)) == 0))
        return ((F.size(lost) == 1) & joined) | (F.size(lost).between(1, 2) & moved)

    return (F.size(F.array_except(ta, tb)) <= 2) & (F.exists(_places(n), by_word) | F.exists(_places(n - 1), by_space))


def subset_grade(a: Column, b: Column) -> Column:
    """2 if title a's tokens are all in b; 1 if they are after one edit of b; else 0."""
    return F.when(tokens_contained(a, b), 2).when(contained_after_edit(a, b), 1).otherwise(0)


#: name -> (builder over the standard columns of a pair table, kind)
REGISTRY: dict[str, tuple[Callable[[], Column], str]] = {
    "shops": (lambda: shop_matches(F.col("product_shops"), F.col("shop")), "numerical"),
    "eans_known": (lambda: ean_known(F.col("product_eans"), F.col("ean")), "discrete"),
    "ean_matches": (lambda: ean_matches(F.col("product_eans"), F.col("ean")), "discrete"),
    "product_in_offer": (lambda: subset_grade(F.col("product_name"), F.col("name")), "discrete"),
    "offer_in_product": (lambda: subset_grade(F.col("name"), F.col("product_name")), "discrete"),
    "name_similarity": (lambda: name_similarity(F.col("product_name"), F.col("name")), "numerical"),
    "i_nameattributes": (lambda: name_attributes.any_common(F.col("product_attributes"), F.col("offer_attributes")), "discrete"),
    "r_nameattributes": (lambda: name_attributes.share_met(F.col("product_attributes"), F.col("offer_attributes")), "numerical"),
}


def evaluate(pairs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """pairs with the named features, or all of them."""
    return pairs.select("*", *(REGISTRY[n][0]().alias(n) for n in (names or REGISTRY)))


def leave_one_out_prices(offers: DataFrame, keys: tuple[str, ...] = ("product_id",)) -> DataFrame:
    """offers with others_n, others_mean, others_m2, others_low, others_high: prices of the product's other offers.

    No list of prices is built: sums and the two smallest and largest prices of a product say what is left without one
    offer. Both are windows over the same groups, so the offers are moved and sorted once; product_low and product_high, the
    range with the offer itself, come along."""
    w = Window.partitionBy(*keys)
    rows = offers.withColumns({
        "_n": F.count("price").over(w),
        "_mean": F.avg("price").over(w),
        "_var": F.var_pop("price").over(w),
        "product_low": F.min("price").over(w),
        "product_high": F.max("price").over(w),
    })
    rows = rows.withColumns({
        "_min2": F.min(F.when(F.col("price") > F.col("product_low"), F.col("price"))).over(w),
        "_max2": F.max(F.when(F.col("price") < F.col("product_high"), F.col("price"))).over(w),
        "_at_min": F.count_if(F.col("price") == F.col("product_low")).over(w),
        "_at_max": F.count_if(F.col("price") == F.col("product_high")).over(w),
    })
    # a price is taken out of the mean and of the squared deviations from it, which doesn't cancel at high prices
    p, n = F.col("price"), F.col("_n") - F.col("price").isNotNull().cast("int")
    off = F.coalesce(p - F.col("_mean"), F.lit(0.0))
    mean = F.when(n > 0, F.col("_mean") - off / n)
    return rows.withColumns({
        "others_n": n,
        "others_mean": mean,
        "others_m2": F.when(n > 0, F.greatest(F.col("_var") * F.col("_n") - off * off * F.col("_n") / n, F.lit(0.0))),
        "others_low": F.when((p == F.col("product_low")) & (F.col("_at_min") == 1), F.col("_min2")).when(n > 0, F.col("product_low")),
        "others_high": F.when((p == F.col("product_high")) & (F.col("_at_max") == 1), F.col("_max2")).when(n > 0, F.col("product_high")),
    }).drop("_n", "_mean", "_var", "_min2", "_max2", "_at_min", "_at_max")


def others_have(pairs: DataFrame, offers: DataFrame, column: str, out: str) -> DataFrame:
    """pairs (offer_id, product_id, current, `column`) with `out`: whether another offer of the product has the pair's value, and
    `<out>_known`: whether another offer has any. The offer's own value doesn't count for its own product."""
    return others_have_each(pairs, offers, {column: out})


def others_have_each(pairs: DataFrame, offers: DataFrame, columns: dict[str, str]) -> DataFrame:
    """others_have for several columns: {column: out}.

    Offers and pairs go to their product together, once. Windows count values and offers there, so no list is built for a product with
    very many offers."""
    rows = pairs.withColumn("_of", F.lit(0)).unionByName(offers.select("product_id", *columns, F.lit(1).alias("_of")), allowMissingColumns=True)
    counted = lambda c: F.sum(F.when(F.col(c).isNotNull() & F.col("product_id").isNotNull(), F.col("_of")).otherwise(0))
    rows = rows.withColumns({f"_any_{c}": counted(c).over(Window.partitionBy("product_id")) for c in columns})
    for c in columns:
        rows = rows.withColumn(f"_same_{c}", counted(c).over(Window.partitionBy("product_id", c)))
    own = lambda c: ((F.col("product_id") == F.col("current")) & F.col(c).isNotNull()).cast("int")
    more = lambda n, c: (F.col(n) - own(c) > 0).cast("int")
    flags = [x for c, out in columns.items() for x in (more(f"_same_{c}", c).alias(out), more(f"_any_{c}", c).alias(f"{out}_known"))]
    return rows.filter("_of = 0").select(*pairs.columns, *flags)


def agreement(pairs: DataFrame, mine: str, theirs: str) -> DataFrame:
    """pairs with n_common, n_matched, any_common and matched_ratio over the attributes of both sides, arrays of (name, value) in
    these columns: names that both have, and those of them with a value that both have. Null lists are empty."""
    kept = lambda c: F.filter(F.coalesce(F.col(c), F.array()), lambda x: x["name"].isNotNull())
    names = lambda c: F.transform(c, lambda x: x["name"])
    a, b = kept(mine), kept(theirs)
    met = F.filter(F.array_intersect(a, b), lambda x: x["value"].isNotNull())
    rows = pairs.withColumns({"n_common": F.size(F.array_intersect(names(a), names(b))).cast("long"), "n_matched": F.size(F.array_distinct(names(met))).cast("long")})
    return rows.withColumns({"any_common": (F.col("n_common") > 0).cast("int"), "matched_ratio": F.when(F.col("n_common") > 0, F.col("n_matched") / F.col("n_common")).otherwise(0.0)})


def attribute_agreement(pairs: DataFrame, offer_attributes: DataFrame, product_attributes: DataFrame) -> DataFrame:
    """agreement of pairs (offer_id, product_id) over attributes (key, name, value) in tables. Each side's attributes are gathered
    in one row, so no pair is moved back to what was counted for it."""
    both = F.collect_set(F.struct("name", "value"))
    rows = pairs.join(offer_attributes.groupBy("offer_id").agg(both.alias("_a")), "offer_id", "left").join(product_attributes.groupBy("product_id").agg(both.alias("_b")), "product_id", "left")
    return agreement(rows, "_a", "_b").select(*pairs.columns, "n_common", "n_matched", "any_common", "matched_ratio")


def dictionary_attributes(titles: DataFrame, dictionary: DataFrame, key: str, words: str) -> DataFrame:
    """(key, category, name, groups): dictionary entries found among the n-grams of titles (key, category, words), up to the
    longest value of the title's category."""
    from offerloom.functions.text import grams
    from offerloom.operators.corpus import longest_values

    rows = titles.select(key, "category", words).join(longest_values(dictionary), "category")
    found = rows.select(key, "category", F.explode(grams(F.col(words), F.col("most_words"))).alias("value"))
    return found.join(dictionary.select("category", "name", "group_id", "value"), ["category", "value"]).groupBy(key, "category", "name").agg(F.collect_set("group_id").alias("groups"))
