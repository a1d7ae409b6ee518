"""Statistics of a title corpus: distinct titles, collocations, attribute dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.sources.scratch import saved


def distinct_titles(sources: list[tuple[DataFrame, list[str]]], preceding: DataFrame | None = None) -> DataFrame:
    """Distinct titles (column title) of several tables' columns and of an earlier corpus; empty ones are left out."""
    parts = [df.select(F.col(c).alias("title")) for df, columns in sources for c in columns]
    parts += [preceding.select("title")] if preceding is not None else []
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.coalesce(F.col("title"), F.lit("")) != "").distinct()


def collocations(titles: DataFrame, words: Column, least_count: int = 5, score_above: float = 10.0, usable: Column | None = None) -> DataFrame:
    """(first, second, n, pmi): pairs of neighbouring words of a title that are seen at least least_count times and whose
    pointwise mutual information log2(n_xy * N / (n_x * n_y)) is above a bound. `usable` filters the column `word`."""
    rows = titles.select(words.alias("_w"))
    singles = rows.select(F.explode("_w").alias("word"))
    counts = saved(singles.groupBy("word").agg(F.count("*").alias("n")), "words")  # titles are cut once for all that is asked of words
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    after = F.expr("slice(_w, 2, size(_w))")
    pairs = rows.filter(F.size("_w") > 1).select(F.explode(F.arrays_zip(F.expr("slice(_w, 1, size(_w) - 1)").alias("first"), after.alias("second"))).alias("p")).select("p.*")
    pairs = pairs.groupBy("first", "second").agg(F.count("*").alias("n_xy")).filter(F.col("n_xy") >= least_count)
    if usable is not None:
        good = counts.filter(usable)
    else:
        good = counts
    out = pairs.join(good.select(F.col("word").alias("first"), F.col("n").alias("n_x")), "first").join(good.select(F.col("word").alias("second"), F.col("n").alias("n_y")), "second")
    n = total.first()["total"]  # one number
    pmi = F.log2(F.col("n_xy") * F.lit(float(n)) / (F.col("n_x").cast("double") * F.col("n_y")))
    return out.select("first", "second", F.col("n_xy").alias("n"), pmi.alias("pmi")).filter(F.col("pmi") > score_above)


def phrased(titles: DataFrame, phrases: DataFrame) -> DataFrame:
    """titles (column title) with `phrased`: the phrases (first, second) inside a title joined by underscores, in the title's
    order. A title meets only the phrases that it holds."""
    from offerloom.functions.text import with_phrases

    words = F.split("title", " ")
    at = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    pairs = titles.select("title").distinct().select("title", F.explode(at).alias("_at"), words.alias("_w"))
    pairs = pairs.select("title", F.get("_w", F.col("_at") - 1).alias("first"), F.get("_w", F.col("_at")).alias("second")).distinct()
    hits = pairs.join(phrases.select("first", "second"), ["first", "second"], "left_semi")
    hits = hits.groupBy("title").agg(F.collect_set(F.concat_ws(" ", "first", "second")).alias("_phrases"))
    rows = titles.join(hits, "title", "left")
    return rows.withColumn("phrased", with_phrases(F.col("title"), F.coalesce("_phrases", F.array().cast("array<string>")))).drop("_phrases")


def attribute_dictionary(attributes: DataFrame, preceding: DataFrame | None = None) -> DataFrame:
    """(category, name, values): sorted distinct values, an earlier dictionary (category, name, value) merged in."""
    rows = attributes.select("category", "name", "value").filter(F.coalesce(F.col("value"), F.lit("")) != "")
    if preceding is not None:
        rows = rows.unionByName(preceding.select("category", "name", "value"))
    return rows.distinct().groupBy("category", "name").agg(F.sort_array(F.collect_list("value")).alias("values"))


def new_values(attributes: DataFrame, preceding: DataFrame) -> DataFrame:
    """How many (category, name, value) the earlier dictionary doesn't have, by category."""
    keys = ["category", "name", "value"]
    return attributes.select(*keys).distinct().join(preceding.select(*keys), keys, "left_anti").groupBy("category").agg(F.count("*").alias("n_new"))


def inverted_dictionary(entries: DataFrame, numeric: Column | None = None) -> DataFrame:
    """(category, value, names, synonyms) from (category, name, group_id, value): what a value may name, and the other values
    of its groups. Numeric values are left out."""
    rows = entries.filter(~numeric) if numeric is not None else entries
    # a group's values are gathered once and meet each of them, not each pair of them
    keys = ["category", "name", "group_id"]
    groups = rows.groupBy(*keys).agg(F.collect_set("value").alias("_group"))
    both = rows.select(*keys, "value").distinct().join(groups, keys)
    return both.groupBy("category", "value").agg(F.sort_array(F.collect_set("name")).alias("names"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("_group")))).alias("synonyms"))


def longest_values(entries: DataFrame) -> DataFrame:
    """The largest number of words of a value, by category."""
    return entries.groupBy("category").agg(F.max(F.size(F.split("value", " "))).alias("most_words"))


def provenance(offer_attributes: DataFrame) -> DataFrame:
    """(product_id, name, value, offers): which offers say so, how many."""
    return offer_attributes.groupBy("product_id", "name", "value").agg(F.countDistinct("offer_id").alias("n_offers"), F.min("offer_id").alias("first_offer"))


def category_sizes(products: DataFrame, offers: DataFrame) -> DataFrame:
    n = offers.groupBy("product_id").agg(F.count("*").alias("_n"))
    rows = products.join(n, "product_id", "left")
    return rows.groupBy("category").agg(F.count("*").alias("n_products"), F.sum(F.coalesce("_n", F.lit(0))).cast("long").alias("n_offers"), F.count_if(F.col("_n").isNotNull()).alias("n_with_offers"))


def characteristic_words(titles: DataFrame, n: int) -> DataFrame:
    """The n most frequent words of each category; ties by the word."""
    from pyspark.sql import Window

    counts = titles.select("category", F.explode("words").alias("word")).groupBy("category", "word").agg(F.count("*").alias("n"))
    at = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n"), "word"))
    return counts.withColumn("place", at).filter(F.col("place") <= n)
