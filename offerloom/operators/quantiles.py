"""Exact quantiles of groups of any size, without a buffer of their values.

A quantile stands between two ranks of the sorted values. All ranks of all groups are looked for at once: each has an interval
that is known to hold it, at first the group's least to its largest value. A round counts the values of each interval in buckets
of equal width, with the least and largest value of each; the bucket in which the rank falls is the interval of the next round.
Intervals that have shrunk to one value are done, so ties cost nothing, and an interval always parts in two at least.

Counts are sums that tasks make of their own rows first, so a group that holds most rows is no heavier than its buckets. Nulls
and what isn't finite are left out; a group without values has null quantiles. Null keys are a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.sources.scratch import saved

BUCKETS = 1024
#: Intervals up to this number are sent to all tasks; more are joined by their group.
MOST_SENT = 100_000


def _same(by: list[str], prefix: str) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def quantiles(rows: DataFrame, by: list[str], value: str, at: list[float]) -> DataFrame:
    """(by..., quantiles): a value for each of `at` (0 to 1), interpolated between the two ranks that it stands between."""
    x = F.col(value).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    values = rows.select(*by, F.when(finite, x).alias("_x"))
    facts = saved(values.groupBy(*by).agg(F.count("_x").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high")), "groups")
    place = F.array(*(F.lit(float(q)) for q in at))
    ranks = F.array_distinct(F.flatten(F.transform(place, lambda q: F.array(F.floor((F.col("_n") - 1) * q), F.ceil((F.col("_n") - 1) * q)))))
    waiting = saved(facts.filter("_n > 0").select(*by, F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_before"), "_low", "_high"), "ranks")
    done = waiting.filter("_low = _high")
    while True:
        waiting = waiting.filter("_low < _high")
        intervals = saved(waiting.select(*(F.col(c).alias(f"_of_{c}") for c in by), "_low", "_high").distinct(), "intervals")
        n = intervals.limit(MOST_SENT + 1).count()
        if not n:
            break
        side = F.broadcast(intervals) if n <= MOST_SENT else intervals
        inside = values.join(side, _same(by, "_of_") & F.col("_x").between(F.col("_low"), F.col("_high")))
        # halves, as the width of an interval may be beyond the largest number
        share = F.try_divide(F.col("_x") / 2 - F.col("_low") / 2, F.col("_high") / 2 - F.col("_low") / 2)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        # the least value always parts from the largest, even where the width is rounded away
        bucket = F.when(F.col("_x") == F.col("_low"), 0).when(F.col("_x") == F.col("_high"), BUCKETS - 1).otherwise(bucket)
        keys = [*by, "_low", "_high"]
        counted = inside.groupBy(*keys, bucket.alias("_bucket")).agg(F.count("*").alias("_m"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
        upto = F.sum("_m").over(Window.partitionBy(*keys).orderBy("_bucket"))
        counted = saved(counted.withColumn("_upto", upto).select(*(F.col(c).alias(f"_of_{c}") for c in by), F.col("_low").alias("_l"), F.col("_high").alias("_h"), "_m", "_upto", "_least", "_most"), "buckets")
        hit = _same(by, "_of_") & (F.col("_low") == F.col("_l")) & (F.col("_high") == F.col("_h")) & (F.col("_rank") - F.col("_before") < F.col("_upto")) & (F.col("_rank") - F.col("_before") >= F.col("_upto") - F.col("_m"))
        waiting = saved(waiting.join(counted, hit).select(*by, "_rank", (F.col("_before") + F.col("_upto") - F.col("_m")).alias("_before"), F.col("_least").alias("_low"), F.col("_most").alias("_high")), "ranks")
        done = done.union(waiting.filter("_low = _high"))

    found = done.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_low"))).alias("_of_rank"))
    found = facts.join(found.select(*(F.col(c).alias(f"_of_{c}") for c in by), "_of_rank"), _same(by, "_of_"), "left")

    def one(q: Column) -> Column:
        spot = (F.col("_n") - 1) * q
        low, high = F.element_at("_of_rank", F.floor(spot)), F.element_at("_of_rank", F.ceil(spot))
        return F.when(F.floor(spot) == F.ceil(spot), low).otherwise(low * (F.ceil(spot) - spot) + high * (spot - F.floor(spot)))

    return found.select(*by, F.when(F.col("_n") > 0, F.transform(place, one)).alias("quantiles"))
