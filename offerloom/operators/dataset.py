"""Pair sets for training: labels, samples, hold-outs, splits. Random choices follow a seeded hash, so they repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded(seed: int, *columns: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))


def labelled_pairs(offers: DataFrame, candidates: DataFrame, least_offers: int) -> DataFrame:
    """(offer_id, product_id, label): an offer with its own product is 1; with another candidate 0, if that candidate has
    enough offers or none at all. Candidates that come with their offer's product in `own` aren't looked up among the offers."""
    own = offers.select("offer_id", "product_id", F.lit(1).alias("label"))
    counts = offers.groupBy("product_id").agg(F.count("*").alias("_n"))
    pairs = candidates if "own" in candidates.columns else candidates.join(offers.select("offer_id", F.col("product_id").alias("own")), "offer_id")
    other = pairs.filter("product_id <> own").select("offer_id", "product_id").join(counts, "product_id", "left").filter(F.col("_n").isNull() | (F.col("_n") >= least_offers))
    # pairs are at their product by now, where copies of them are as well; no pair has both labels
    return own.distinct().unionByName(other.select("offer_id", "product_id", F.lit(0).alias("label")).distinct())


def top_offers(offers: DataFrame, n: int, order: str = "n_candidates") -> DataFrame:
    """At most n offers per product, those with most candidates; ties by id."""
    place = F.row_number().over(Window.partitionBy("product_id").orderBy(F.desc(order), "offer_id"))
    return offers.withColumn("place", place).filter(F.col("place") <= n)


def first_by_hash(rows: DataFrame, by: list[str], key: list[str], seed: int, take: Callable[[Column], Column]) -> DataFrame:
    """rows with `chosen`: whether a row is among the first take(n) of the n rows of its group, in the order of a seeded hash.

    A group's rows are counted in 4096 ranges of the hash; ranges that are taken or left as a whole need no order, and only
    the one range where the number runs out is sorted. So a group of any size is spread over tasks."""
    hashed = rows.withColumn("_h", seeded(seed, *key)).withColumn("_range", F.substring("_h", 1, 3))
    counts = hashed.groupBy(*by, "_range").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_c").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.withColumns({"_before": before, "_take": take(F.sum("_c").over(w))})
    marked = hashed.join(ranges.withColumnsRenamed({c: f"_by_{c}" for c in by}).withColumnRenamed("_range", "_r"), [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("_range") == F.col("_r")])
    edge = (F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_c") > F.col("_take"))
    whole = marked.filter(~edge).withColumn("chosen", F.col("_before") < F.col("_take"))
    place = F.row_number().over(Window.partitionBy(*by, "_range").orderBy("_h", *key))
    split = marked.filter(edge).withColumn("chosen", place + F.col("_before") <= F.col("_take"))
    return whole.unionByName(split).select(*rows.columns, "chosen")


def sampled_products(products: DataFrame, share: float, seed: int) -> DataFrame:
    """A share of each category's products, at least one."""
    rows = first_by_hash(products, ["category"], ["product_id"], seed, lambda n: F.greatest(F.lit(1), F.floor(n * share)))
    return rows.filter("chosen").drop("chosen")


def grouped_holdout(offers: DataFrame, train_share: float, most: int, seed: int, preceding: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(test, train) offers: per category min(n * (1 - train_share), most) random offers are for testing, and every product
    that they touch leaves training. Earlier test offers stay test offers and aren't drawn."""
    kept = offers.join(preceding.select("offer_id").distinct(), "offer_id", "left_semi") if preceding is not None else offers.limit(0)
    free = offers.join(kept.select("offer_id"), "offer_id", "left_anti") if preceding is not None else offers
    drawn = first_by_hash(free, ["category"], ["offer_id"], seed, lambda n: F.least(F.floor(n * F.round(F.lit(1 - train_share), 9)), F.lit(most)))
    test = drawn.filter("chosen").select(offers.columns).unionByName(kept.select(offers.columns))
    return test, offers.join(test.select("product_id").distinct(), "product_id", "left_anti")


def stratified_split(rows: DataFrame, strata: list[str], share: float, seed: int, key: list[str]) -> DataFrame:
    """rows with `part`: `first` for a share of each stratum, else `second`."""
    rows = first_by_hash(rows, strata, key, seed, lambda n: F.round(n * share))
    return rows.withColumn("part", F.when(F.col("chosen"), "first").otherwise("second")).drop("chosen")


def augmented(rows: DataFrame, label: str = "label", least: int = 6, least_each: int = 2) -> DataFrame:
    """A tiny set filled up by repeating rows: at least `least_each` rows of each label and `least` in all."""
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows
    each = max(least_each, -(-least // len(counts)))
    copies = F.lit(1)
    for value, n in counts.items():
        copies = F.when(F.col(label) == value, max(1, -(-each // n))).otherwise(copies)
    return rows.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).drop("_c")


def updated(new: DataFrame, preceding: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where both have a key, the new row stays."""
    rows = new.withColumn("_s", F.lit(0)).unionByName(preceding.withColumn("_s", F.lit(1)))
    return rows.withColumn("_p", F.row_number().over(Window.partitionBy(*keys).orderBy("_s"))).filter("_p = 1").drop("_s", "_p")


def overridden(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """New columns beside old ones; where both have a column, the new one stays."""
    return new.join(old.drop(*(c for c in old.columns if c in new.columns and c not in keys)), keys)


def by_precedence(stores: list[DataFrame], key: str) -> DataFrame:
    """Rows of several stores by key; a later store wins."""
    rows = None
    for n, df in enumerate(stores):
        part = df.withColumn("_s", F.lit(n))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows.withColumn("_p", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_s")))).filter("_p = 1").drop("_s", "_p")


def next_versions(snapshots: DataFrame, wanted: DataFrame, most_missing: float = 0.8) -> DataFrame:
    """(category, version) for a snapshot: the highest so far plus one, or 0. Too many wanted categories without any snapshot
    data are an error."""
    have = snapshots.groupBy("category").agg(F.max("version").alias("_v"))
    rows = wanted.select("category").distinct().join(have, "category", "left")
    return rows.select("category", F.coalesce(F.col("_v") + 1, F.lit(0)).alias("version"))


def sibling_offers(decisions: DataFrame, offers: DataFrame, mismatch_only: bool = True) -> DataFrame:
    """Other offers of the product that a decided offer is in now: (decision_offer, final_product, product_id, offer_id)."""
    now = decisions.select(F.col("offer_id").alias("decision_offer"), "final_product").join(offers.select(F.col("offer_id").alias("decision_offer"), "product_id"), "decision_offer")
    if mismatch_only:
        now = now.filter("final_product is null or final_product <> product_id")
    return now.join(offers.select("offer_id", "product_id"), "product_id").filter("offer_id <> decision_offer")
