"""Attributes that a dictionary finds in titles, and what a pair of titles has in common.

The dictionary is a table (category, name, group_id, value): the values of a group are synonyms. Its values are laid out as a
trie of words, one table of edges for all depths. Every place of a title starts at the root of its category; each round joins
the places that are still on a path with the edges for their next word, so a title costs one row per word in the first round
and only what the dictionary goes on with after that, however long its longest value is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.sources.scratch import saved

#: Values of numbers, signs and capitals only tell nothing by themselves ("5-10", "15%"). Fixed value.
NO_WORDS = r"^[ 0-9.,-_%*+]+$"


def synonyms(dictionary: DataFrame) -> DataFrame:
    """(category, value, names, synonyms): all values of the groups that have the value, under whatever name."""
    groups = dictionary.filter("value is not null").groupBy("category", "name", "group_id").agg(F.collect_set("value").alias("group"))
    each = groups.select("category", "name", "group", F.explode("group").alias("value")).filter(~F.col("value").rlike(NO_WORDS))
    rows = each.withColumn("value", F.btrim("value")).groupBy("category", "value")
    return rows.agg(F.array_sort(F.collect_set("name")).alias("names"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("group")))).alias("synonyms"))


def edges(values: DataFrame) -> DataFrame:
    """(category, depth, so_far, word, here, is_value): the trie of (category, value), by words."""
    words = F.split("value", " ")
    path = values.select("category", "value", words.alias("words"), F.posexplode(words).alias("depth", "word"))
    so_far, here = (F.array_join(F.slice("words", F.lit(1), F.col("depth") + n), " ") for n in (0, 1))
    return path.select("category", "depth", so_far.alias("so_far"), "word", here.alias("here"), (F.size("words") == F.col("depth") + 1).alias("ends")).groupBy("category", "depth", "so_far", "word", "here").agg(F.bool_or("ends").alias("is_value"))


def found_values(titles: DataFrame, values: DataFrame) -> DataFrame:
    """(category, title, value) for the values (category, value) among the words of titles (category, title), once each."""
    trie = saved(edges(values), "trie")
    words = F.split("title", " ")
    places = titles.filter("title is not null").distinct().select("category", "title", words.alias("words"), F.explode(F.sequence(F.lit(0), F.size(words) - 1)).alias("at"), F.lit("").alias("so_far"))
    found, depth = None, 0
    while True:
        step = trie.filter(F.col("depth") == depth).drop("depth")
        next_ = places.withColumn("word", F.get("words", F.col("at") + depth)).join(step, ["category", "so_far", "word"])
        on_path = saved(next_.select("category", "title", "words", "at", F.col("here").alias("so_far"), "is_value"), "on-path")
        mine = on_path.filter("is_value").select("category", "title", F.col("so_far").alias("value"))
        found, places, depth = mine if found is None else found.union(mine), on_path.drop("is_value"), depth + 1
        if on_path.isEmpty():
            return found.distinct()


def title_attributes(titles: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(category, title, attributes): (name, synonyms) of the dictionary values found in titles (category, title). Titles and
    categories without any are left out."""
    known = saved(synonyms(dictionary), "synonyms")
    found = found_values(titles, known.select("category", "value")).join(known, ["category", "value"])
    by_name = found.select("category", "title", F.explode("names").alias("name"), "synonyms").groupBy("category", "title", "name")
    sets = by_name.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("synonyms")))).alias("synonyms"))
    return sets.groupBy("category", "title").agg(F.array_sort(F.collect_list(F.struct("name", "synonyms"))).alias("attributes"))


def with_attributes(pairs: DataFrame, dictionary: DataFrame, product_title: str = "product_name", offer_title: str = "name") -> DataFrame:
    """pairs (category and two normalised titles) with product_attributes and offer_attributes, empty where nothing is found.
    Each different title is looked at once."""
    titles = pairs.select("category", F.col(product_title).alias("title")).union(pairs.select("category", offer_title))
    known = saved(title_attributes(titles, dictionary), "title-attributes")
    none = F.array().cast(known.schema["attributes"].dataType)
    out = pairs
    for column, title in (("product_attributes", product_title), ("offer_attributes", offer_title)):
        side = known.select(F.col("category").alias("_c"), F.col("title").alias("_t"), F.col("attributes").alias(column))
        out = out.drop(column).join(side, (F.col("category") == F.col("_c")) & (F.col(title) == F.col("_t")), "left").drop("_c", "_t")
        out = out.withColumn(column, F.coalesce(column, none))
    return out


def _of_name(attributes: Column, name: Column) -> Column:
    """Synonyms of a name; null if the title has none."""
    return F.get(F.filter(attributes, lambda y: y["name"] == name), F.lit(0))["synonyms"]


def common(a: Column, b: Column) -> Column:
    """Attributes of a under names that b has too."""
    return F.filter(a, lambda x: _of_name(b, x["name"]).isNotNull())


def any_common(a: Column, b: Column) -> Column:
    return (F.size(common(a, b)) > 0).cast("double")


def share_met(a: Column, b: Column) -> Column:
    """Share of the common names under which the two titles have a value or synonym in common; 0 without common names."""
    both = common(a, b)
    met = F.filter(both, lambda x: F.arrays_overlap(x["synonyms"], _of_name(b, x["name"])))
    return F.when(F.size(both) > 0, F.size(met) / F.size(both)).otherwise(0.0)


def agree(a: Column, b: Column, soft: bool = True) -> Column:
    """No common name contradicts: under each, the synonyms of both titles meet (soft), or one's are all among the other's."""

    def meets(x: Column) -> Column:
        mine, other = x["synonyms"], _of_name(b, x["name"])
        if soft:
            return F.arrays_overlap(mine, other)
        return (F.size(F.array_except(mine, other)) == 0) | (F.size(F.array_except(other, mine)) == 0)

    return F.forall(common(a, b), meets)
