"""Attribute lists as maps and sets of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_name(attributes: Column) -> Column:
    """name -> value of an array of (name, value, ...); the last of several values counts, empty ones don't. Null: no names."""
    told = F.filter(F.coalesce(attributes, F.array()), lambda a: a["name"].isNotNull() & (F.coalesce(a["value"], F.lit("")) != ""))
    names = F.array_distinct(F.transform(told, lambda a: a["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(told, lambda a: a["name"] == n), -1)["value"]))


def by_unit(attributes: Column) -> Column:
    """unit -> its different values in order; attributes without a unit or a value don't count. Null: no units."""
    told = F.filter(F.coalesce(attributes, F.array()), lambda a: (F.coalesce(a["unit"], F.lit("")) != "") & (F.coalesce(a["value"], F.lit("")) != ""))
    units = F.array_distinct(F.transform(told, lambda a: a["unit"]))
    values = lambda u: F.array_sort(F.array_distinct(F.transform(F.filter(told, lambda a: a["unit"] == u), lambda a: a["value"])))
    return F.map_from_arrays(units, F.transform(units, values))


def union_over_offers(offers: DataFrame, key: str, columns: list[str], synonyms: dict[str, str] | None = None) -> DataFrame:
    """(key, name, values): the values that a product's offers have for each attribute, over several attribute lists. Names that
    mean the same (a producer is a brand) count as one."""
    lists = F.concat(*(F.coalesce(F.col(c), F.array()) for c in columns))
    rows = offers.select(key, F.explode(lists).alias("a")).select(key, F.col("a.name").alias("name"), F.col("a.value").alias("value")).filter("name is not null and coalesce(value, '') <> ''")
    if synonyms:
        same = F.create_map(*(F.lit(x) for pair in synonyms.items() for x in pair))
        rows = rows.withColumn("name", F.coalesce(F.element_at(same, F.col("name")), "name"))
    return rows.groupBy(key, "name").agg(F.sort_array(F.collect_set("value")).alias("values"))
