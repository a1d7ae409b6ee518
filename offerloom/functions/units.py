"""Quantities in titles: a table of (title, unit, multipliers, number), and conflicts between two titles' quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.text import FACTORS, NUM, SIGN, UNITS_STOCK, unit_patterns


def _block(unit: str) -> str:
    """Numbers with or without a unit, joined by signs; a number of pieces may follow after a space."""
    nu = rf"{NUM}(?:{unit})?"
    return rf"{nu}(?:(?:{SIGN}){nu}| {nu})*\b"


def quantities(titles: DataFrame, key: str, title: str, conversions: bool = False) -> DataFrame:
    """(key, unit, multipliers, number) for normalised titles. Multipliers are sorted as text; a number of pieces beside a
    quantity multiplies it; numbers with a leading zero that isn't a fraction are no quantities."""
    unit = unit_patterns(conversions)["unit"]
    words = r"\s+(?:[a-z]+\s+)+"
    squash = rf"({NUM})\s*({unit})?\W*?\s*(?:([x*]){words}|{words}([x*]))\s*({NUM})\s*({unit})?"
    rows = titles.select(key, F.regexp_replace(title, squash, "$1$2$3$4$5$6").alias("_t"))
    rows = rows.select(key, F.explode(F.array_distinct(F.regexp_extract_all("_t", F.lit(_block(unit)), F.lit(0)))).alias("_block"))
    rows = rows.withColumn("_block", F.btrim("_block")).filter(F.col("_block").rlike(unit))
    stock = rf"({NUM})({UNITS_STOCK})"
    pieces = F.regexp_extract("_block", stock, 1)
    rest = F.replace(F.regexp_replace("_block", stock, ""), F.lit(" "), F.lit(""))
    rows = rows.withColumn(
        "_block",
        F.when(pieces == "", F.col("_block"))
        .when(rest == "", F.concat(pieces, F.lit("ks")))
        .when(pieces.try_cast("double") > 1, F.concat(pieces, F.lit("*"), rest))
        .otherwise(rest),
    )
    part = rf"(?:{NUM}(?:{SIGN}))*{NUM}(?:{unit})(?:$|\s|\+|(?:[x*]{NUM})+)"
    rows = rows.select(key, F.explode(F.regexp_extract_all("_block", F.lit(part), F.lit(0))).alias("_part"))
    rows = rows.select(key, F.split(F.btrim("_part", F.lit(" +x*")), r"(?<![a-z])[x+*]|[x+*](?![a-z])").alias("_pieces"))
    at = F.array_position(F.transform("_pieces", lambda p: p.rlike(unit)), True)
    main = F.get("_pieces", (at - 1).cast("int"))
    others = F.array_sort(F.filter("_pieces", lambda p, i: i != at - 1))
    rows = rows.filter(at > 0).select(key, F.regexp_extract(main, rf"^({NUM})({unit})", 2).alias("unit"), others.alias("multipliers"), F.regexp_extract(main, rf"^({NUM})", 1).alias("number"))
    plain = F.col("number").startswith("0.") | ~F.col("number").startswith("0")
    return rows.filter((F.col("unit") != "") & plain).distinct()


def plain_number(x: Column) -> Column:
    """A number as text without trailing zeros."""
    text = F.round(x, 9).cast("decimal(38,9)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def base_units(spark: SparkSession) -> DataFrame:
    """(unit, base, factor): as many rows as prefixes times short units, so it may be broadcast."""
    short = unit_patterns(True)["short"].split("|")
    return spark.createDataFrame([(p + u, u, f) for p, f in FACTORS.items() for u in short], "unit string, base string, factor double")


def in_base_units(q: DataFrame) -> DataFrame:
    known = q.join(F.broadcast(base_units(q.sparkSession)), "unit", "left")
    number = F.when(F.col("base").isNotNull(), plain_number(F.replace("number", F.lit(","), F.lit(".")).cast("double") * F.col("factor"))).otherwise(F.col("number"))
    return known.withColumns({"number": number, "unit": F.coalesce("base", "unit")}).drop("base", "factor").distinct()


def with_attribute_quantities(q: DataFrame, attributes: DataFrame) -> DataFrame:
    """Quantities with those of attributes (key, unit, number) beside them."""
    more = attributes.withColumn("multipliers", F.array().cast("array<string>"))
    return q.unionByName(more.select(q.columns)).distinct()


def per_unit(q: DataFrame, key: str) -> DataFrame:
    value = F.concat_ws("*", F.array_join("multipliers", "*"), "number")
    return q.groupBy(key, "unit").agg(F.collect_set(value).alias("values"))


def by_title(q: DataFrame, key: str) -> DataFrame:
    """(key, quantities): an array of (unit, values) for each title that has any."""
    return per_unit(q, key).groupBy(key).agg(F.collect_list(F.struct("unit", "values")).alias("quantities"))


def conflict(a: Column, b: Column) -> Column:
    """What `conflicts` says of two titles, from their quantities as by_title has them. Null arrays are empty."""
    def grade(x: Column, y: Column) -> Column:
        extra_x, extra_y = F.size(F.array_except(x["values"], y["values"])) > 0, F.size(F.array_except(y["values"], x["values"])) > 0
        return F.when(extra_x & extra_y, 2).when(extra_x | extra_y, 1).otherwise(0)

    grades = F.flatten(F.transform(a, lambda x: F.transform(F.filter(b, lambda y: y["unit"] == x["unit"]), lambda y: grade(x, y))))
    worst = F.coalesce(F.array_max(grades), F.lit(0))
    return F.when(worst == 2, "no").when(worst == 1, "unknown").otherwise("ok")


def conflicts(pairs: DataFrame, a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """pairs with `quantity`: over units that both have, no if both sides have values of their own in some unit, unknown if
    one side has, else ok."""
    both = pairs.select(a_key, b_key).join(per_unit(a, a_key).withColumnRenamed("values", "_a"), a_key).join(per_unit(b, b_key).withColumnRenamed("values", "_b"), [b_key, "unit"])
    extra_a, extra_b = F.size(F.array_except("_a", "_b")) > 0, F.size(F.array_except("_b", "_a")) > 0
    worst = both.groupBy(a_key, b_key).agg(F.max(F.when(extra_a & extra_b, 2).when(extra_a | extra_b, 1).otherwise(0)).alias("_w"))
    out = pairs.join(worst, [a_key, b_key], "left")
    return out.withColumn("quantity", F.when(F.col("_w") == 2, "no").when(F.col("_w") == 1, "unknown").otherwise("ok")).drop("_w")
