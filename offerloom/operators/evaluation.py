"""How good decisions are: business metrics with confidence, thresholds, comparison of models, feature statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from offerloom.functions import special

Z95 = 1.959963984540054


def business_metrics(decisions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per category and for `all`: coverage (matched or new product), matched share, precision on matched. Takes rows of
    evaluation_decision; invalid offers don't count."""
    by = by or ["category"]
    is_ = lambda d: F.count_if(F.col("final_decision") == d)
    rows = decisions.filter("final_decision <> 'invalid'").rollup(*by).agg(is_("matched").alias("n_matched"), is_("new_product").alias("n_new"), is_("unknown").alias("n_unknown"), F.count_if("is_current").alias("n_correct"), F.count("*").alias("n"))
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("all")) for c in by})
    return rows.withColumns({
        "coverage": F.when(F.col("n") > 0, (F.col("n_matched") + F.col("n_new")) / F.col("n")),
        "matched_share": F.when(F.col("n") > 0, F.col("n_matched") / F.col("n")),
        "precision": F.when(F.col("n_matched") > 0, F.col("n_correct") / F.col("n_matched")),
    })


def segment_metrics(decisions: DataFrame, preceding: DataFrame) -> DataFrame:
    """business_metrics per segment: Overall, and apart from each other the offers (offer_id) that an earlier run has seen, and new
    ones."""
    seen = decisions.join(preceding.select("offer_id", F.lit(True).alias("_seen")).distinct(), "offer_id", "left")
    segment = F.explode(F.array(F.lit("Overall"), F.when(F.col("_seen"), "Preceding items").otherwise("New items")))
    rows = seen.withColumn("segment", segment).drop("_seen")
    return business_metrics(rows, ["segment", "category"]).filter("segment <> 'all'")


@F.pandas_udf(DoubleType())
def rate_confidence(successes: pd.Series, n: pd.Series, bound: pd.Series) -> pd.Series:
    """P(rate > bound) under a uniform prior: the tail of Beta(s + 1, n - s + 1), for whole columns at once."""
    s, m, p = (x.astype("float64").to_numpy() for x in (successes, n, bound))
    known = ~(np.isnan(s) | np.isnan(m) | np.isnan(p))
    out = np.full(len(s), np.nan)
    out[known] = special.beta_tail(s[known] + 1, m[known] - s[known] + 1, p[known])
    return pd.Series(out).where(known, None).astype("float64")


def rate_interval(successes: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Interval of a rate on the logit scale; 0 and 1 where the rate is 0, 1 or unknown."""
    rate = F.when(n > 0, successes / n)
    inner = (rate > 0) & (rate < 1)
    logit = F.log(rate / (1 - rate))
    half = F.lit(z) / F.sqrt(n * rate * (1 - rate))
    low, high = 1 / (1 + F.exp(-(logit - half))), 1 / (1 + F.exp(-(logit + half)))
    return F.when(inner, low).otherwise(0.0), F.when(inner, high).otherwise(1.0)


def against_previous(metrics: DataFrame, previous: DataFrame) -> DataFrame:
    """Current metrics beside the previous run's, and the confidence that precision is higher now."""
    old = previous.select("category", F.col("precision").alias("previous_precision"), F.col("matched_share").alias("previous_matched_share"))
    rows = metrics.join(old, "category", "left")
    return rows.withColumn("precision_confidence", rate_confidence(F.col("n_correct"), F.col("n_matched"), F.col("previous_precision")))


def threshold_steps() -> Column:
    """0.300, 0.305, ... 0.995."""
    return F.transform(F.sequence(F.lit(300), F.lit(995), F.lit(5)), lambda x: x / F.lit(1000.0))


def _steps_up_to(x: Column) -> Column:
    """How many thresholds are x or less; 0 for null. The quotient may be off by one, so its neighbours are looked at."""
    steps, most = threshold_steps(), 140
    k = F.least(F.greatest(F.floor((x - 0.3) / 0.005).cast("int"), F.lit(0)), F.lit(most - 1))
    return F.when(x.isNull() | (x < 0.3), 0).when(F.get(steps, k) > x, k).when(F.get(steps, k + 1) <= x, k + 2).otherwise(k + 1)


def threshold_sweep(pairs: DataFrame, offers: DataFrame) -> DataFrame:
    """(threshold, n, n_matched, n_correct, precision, matched_share): offers decided anew for each threshold.

    Takes pairs (offer_id, product_id, decision, score) where a null score keeps its decision, and offers (offer_id,
    product_id). A pair with a score is yes from its score on, so an offer has just one yes on one interval of thresholds:
    without a fixed yes from above its second score to its first, with one above its first score. An interval adds one at its
    start and takes it away at its end; sums along the thresholds give the counts."""
    return _swept(offers.join(_best_two(pairs, ["offer_id"]), "offer_id", "left"))


def threshold_sweep_of_pairs(pairs: DataFrame, current: str) -> DataFrame:
    """threshold_sweep of offers that all have candidates: pairs tell their product in `current`, so no table of offers is joined."""
    return _swept(_best_two(pairs, [current, "offer_id"]).withColumnRenamed(current, "product_id"))


def _best_two(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Per offer its two best scores (top, second), top_product, and of the pairs without a score how many are yes, with the smallest
    product (yes, yes_product)."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last("score"), "product_id"))
    at = lambda k, c: F.max(F.when((F.col("_p") == k) & F.col("score").isNotNull(), F.col(c)))
    fixed = F.col("score").isNull() & (F.col("decision") == "yes")
    return pairs.withColumn("_p", place).groupBy(*by).agg(
        at(1, "score").alias("top"), at(2, "score").alias("second"), at(1, "product_id").alias("top_product"),
        F.count_if(fixed).alias("yes"), F.min(F.when(fixed, F.col("product_id"))).alias("yes_product"),
    )


def _swept(rows: DataFrame) -> DataFrame:
    """The sweep from one row per offer."""
    rows = rows.withColumn("yes", F.coalesce("yes", F.lit(0)))
    steps = F.size(threshold_steps())
    begin = F.when(F.col("yes") == 1, _steps_up_to(F.col("top"))).otherwise(_steps_up_to(F.col("second")))
    end = F.when(F.col("yes") == 1, steps).when(F.col("yes") == 0, _steps_up_to(F.col("top"))).otherwise(0)
    right = F.coalesce(F.when(F.col("yes") == 1, F.col("yes_product")).otherwise(F.col("top_product")) == F.col("product_id"), F.lit(False)).cast("int")
    rows = rows.select(begin.alias("begin"), end.alias("end"), right.alias("right")).withColumn("any", F.col("begin") < F.col("end"))
    move = lambda step, by, right, n: F.struct(step.alias("step"), F.lit(by).alias("by"), right.alias("right"), F.lit(n).alias("n"))
    moves = F.array(move(F.col("begin"), 1, F.col("right"), 1), move(F.col("end"), -1, -F.col("right"), 0))
    none = F.array(move(F.lit(0), 0, F.lit(0), 1))
    # a row for each place where intervals begin or end: 141 at most, whatever the number of offers
    sums = rows.select(F.inline(F.when(F.col("any"), moves).otherwise(none))).groupBy("step").agg(F.sum("by").alias("by"), F.sum("right").alias("right"), F.sum("n").alias("n"))
    grid = rows.sparkSession.range(1).select(F.posexplode(threshold_steps()).alias("step", "threshold")).join(sums, "step", "full")
    along = Window.orderBy("step")
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = grid.select("threshold", total("n", whole).alias("n"), total("by", along).alias("n_matched"), total("right", along).alias("n_correct")).filter("threshold is not null")
    return out.select("threshold", "n", "n_matched", "n_correct", F.when(F.col("n_matched") > 0, F.col("n_correct") / F.col("n_matched")).alias("precision"), (F.col("n_matched") / F.col("n")).alias("matched_share"))


def best_threshold(sweep: DataFrame, weights: int = 91) -> DataFrame:
    """(threshold, wins): for each weight 1.0, 1.1, ... all thresholds that maximise precision + weight * matched share; the
    threshold with most wins, the highest on ties. The sweep has as many rows as thresholds."""
    rows = sweep.filter("precision is not null").withColumn("w", F.explode(F.transform(F.sequence(F.lit(0), F.lit(weights - 1)), lambda i: 1 + i / F.lit(10.0))))
    rows = rows.withColumn("value", F.round(F.col("precision") + F.col("w") * F.col("matched_share"), 9))
    best = rows.withColumn("_best", F.max("value").over(Window.partitionBy("w"))).filter("value = _best")
    return best.groupBy("threshold").agg(F.count("*").alias("wins")).orderBy(F.desc("wins"), F.desc("threshold")).limit(1)


DECISIONS = ["matched", "new_product", "unknown", "invalid"]


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """(offer_id, decision_a, decision_b) over all offers of either; `missing` where one has none."""
    left, right = (x.select("offer_id", F.col("final_decision").alias(n)) for x, n in ((a, "decision_a"), (b, "decision_b")))
    return left.join(right, "offer_id", "full").fillna("missing", ["decision_a", "decision_b"])


def comparison_table(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("decision_a").pivot("decision_b", [*DECISIONS, "missing"]).count().fillna(0)


def rerun_status(rows: DataFrame) -> DataFrame:
    """rows (human, first, second) with status: better, worse, unchanged or undefined. A decision is worth 1 if it is the
    human's, -1 if it is the opposite, 0 if unknown."""
    worth = lambda c: F.when(~F.col(c).isin("yes", "no", "unknown"), None).when(F.col(c) == "unknown", 0).when(F.col(c) == F.col("human"), 1).otherwise(-1)
    a, b = worth("first"), worth("second")
    known = F.col("human").isin("yes", "no")
    return rows.withColumn("status", F.when(~F.coalesce(known, F.lit(False)) | a.isNull() | b.isNull(), "undefined").when(b > a, "better").when(b < a, "worse").otherwise("unchanged"))


def mostly_missing(df: DataFrame, most: float = 0.8) -> DataFrame:
    """df without the columns that are null in more than `most` of the rows."""
    shares = df.agg(*(F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns)).first()
    return df.drop(*(c for c in df.columns if (shares[c] or 0) > most))


def dominant_values(df: DataFrame, columns: list[str], most: float = 0.99) -> DataFrame:
    """(feature, value, share, constant): the most frequent value of each discrete feature; ties by the value."""
    rows = df.select(*(F.col(c).cast("string").alias(c) for c in columns)).unpivot([], columns, "feature", "value")
    counts = rows.groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("null"), "value"))
    out = counts.groupBy("feature").agg(best.alias("best"), F.sum("n").alias("all"))
    share = -F.col("best.n") / F.col("all")
    return out.select("feature", F.col("best.value").alias("value"), share.alias("share"), (share >= most).alias("constant"))


def class_weight(labels: DataFrame, column: str = "label") -> DataFrame:
    positives, negatives = F.count_if(F.col(column) == 1), F.count_if(F.col(column) == 0)
    return labels.agg(positives.alias("n_positive"), negatives.alias("n_negative"), F.when(positives > 0, negatives / positives).alias("weight"))


def pr_points(scored: DataFrame, buckets: int = 1000) -> DataFrame:
    """(score, precision, recall, f1) at each distinct score from above: label 0 or 1, score 0 to 1.

    Counts are summed per score first and per bucket of scores next, so that no single task has to sort all rows."""
    each = scored.groupBy("score").agg(F.sum("label").cast("long").alias("tp"), F.count("*").alias("n")).withColumn("_b", F.least(F.floor(F.col("score") * buckets), F.lit(buckets - 1)).cast("int"))
    inside = Window.partitionBy("_b").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumns({"_tp": F.sum("tp").over(inside), "_n": F.sum("n").over(inside)})
    sums = each.groupBy("_b").agg(F.sum("tp").alias("_btp"), F.sum("n").alias("_bn"))  # at most `buckets` rows
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select("_b", F.coalesce(F.sum("_btp").over(above), F.lit(0)).alias("_tp0"), F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_n0"), F.sum("_btp").over(whole).alias("_all"))
    rows = each.join(F.broadcast(sums), "_b")
    tp, n = F.col("_tp") + F.col("_tp0"), F.col("_n") + F.col("_n0")
    rows = rows.select("score", (tp / n).alias("precision"), F.when(F.col("_all") > 0, tp / F.col("_all")).alias("recall"))
    return rows.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def assigned_clusters(rows: DataFrame) -> DataFrame:
    """(category, cluster, n, share, lead): each category's largest cluster, and how far its share is before the second (1 if
    it is alone). Ties by cluster."""
    counts = rows.groupBy("category", "cluster").agg(F.count("*").alias("n"))
    w = Window.partitionBy("category")
    order = w.orderBy(F.desc("n"), "cluster")
    counts = counts.withColumn("share", F.col("n") / F.sum("n").over(w))
    counts = counts.withColumns({"lead": F.coalesce(F.col("share") - F.lead("share").over(order), F.lit(1.0)), "_p": F.row_number().over(order)})
    return counts.filter("_p = 1").drop("_p")


#: Decisions in the order of reports.
REPORT_ORDER = ("yes", "unknown", "no", "invalid", "failed")


def report_places() -> dict[str, int]:
    """Places of the known decisions."""
    return {d: k + 1 for k, d in enumerate(REPORT_ORDER)}


def report_place(decision: Column) -> Column:
    """Place of a decision in reports, from 1; others come last. For orderBy."""
    at = F.array_position(F.array(*map(F.lit, REPORT_ORDER)), decision)
    return F.when(at > 0, at).otherwise(len(REPORT_ORDER) + 1).cast("int")


def common_items(a: DataFrame, b: DataFrame) -> DataFrame:
    """Items of both sets; an error if there are none, as nothing could be compared."""
    both = a.intersect(b)
    if both.isEmpty():
        raise ValueError("the two sets have no item in common")
    return both


def cell_rows(a: DataFrame, b: DataFrame, decision_a: str, decision_b: str) -> DataFrame:
    """The pairs (offer_id, product_id, decision, final_decision) of both runs behind one cell of their comparison, with `side`."""
    cell = compared(*(x.select("offer_id", "final_decision").distinct() for x in (a, b))).filter((F.col("decision_a") == decision_a) & (F.col("decision_b") == decision_b)).select("offer_id")
    sides = [x.join(cell, "offer_id", "left_semi").withColumn("side", F.lit(name)) for name, x in (("a", a), ("b", b))]
    return sides[0].unionByName(sides[1])


def pr_summary(points: DataFrame) -> DataFrame:
    """(area, best_f1, best_score) of pr_points(): area by trapezoids from recall 0 at the first precision on; the highest score
    with the best F1. Neighbours are found inside ranges of recall, which then meet in one row each."""
    rows = points.withColumn("_b", F.floor(F.col("recall") * 1000).cast("int"))
    order = Window.partitionBy("_b").orderBy(F.desc("score"))
    inner = rows.withColumns({"_r": F.lag("recall").over(order), "_p": F.lag("precision").over(order)})
    part = F.coalesce((F.col("recall") - F.col("_r")) * (F.col("precision") + F.col("_p")) / 2, F.lit(0.0))
    ends = lambda by: by(F.struct("recall", "precision"), "score")
    ranges = inner.groupBy("_b").agg(F.sum(part).alias("area"), ends(F.max_by).alias("first"), ends(F.min_by).alias("last"), F.max(F.struct("f1", "score")).alias("best"))  # 1001 rows at most
    before = F.lag("last").over(Window.orderBy("_b"))
    start = F.coalesce(before, F.struct(F.lit(0.0).alias("recall"), F.col("first.precision").alias("precision")))
    ranges = ranges.withColumn("start", start)
    joint = (F.col("first.recall") - F.col("start.recall")) * (F.col("first.precision") + F.col("start.precision")) / 2
    return ranges.agg(F.sum(F.col("area") + joint).alias("area"), F.max("best").alias("best")).select("area", F.col("best.f1").alias("best_f1"), F.col("best.score").alias("best_score"))


def characteristic_titles(rows: DataFrame, words: DataFrame, share: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(rows whose number of their category's characteristic words reaches the category's quantile, counts before and after).

    rows: key, category, words (array); words: (category, word), few for each category."""
    known = words.groupBy("category").agg(F.collect_set("word").alias("_known"))
    counted = rows.join(F.broadcast(known), "category", "left").withColumn("n_characteristic", F.coalesce(F.size(F.array_intersect("words", "_known")), F.lit(0))).drop("_known")
    # few different counts for each category, so the quantile is taken over them and their frequencies
    limits = counted.groupBy("category", "n_characteristic").agg(F.count("*").alias("n")).groupBy("category").agg(F.percentile("n_characteristic", share, F.col("n")).alias("least"), F.sum("n").alias("n_before"))
    kept = counted.join(F.broadcast(limits), "category").filter(F.col("n_characteristic") >= F.col("least"))
    after = kept.groupBy("category").agg(F.count("*").alias("n_after"))
    return kept.drop("least", "n_before"), limits.join(after, "category", "left").select("category", "least", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))


def cluster_summary(rows: DataFrame) -> DataFrame:
    """(k, cluster, n_products, n_categories, share) from (k, cluster, product_id, category)."""
    sums = rows.groupBy("k", "cluster").agg(F.count("*").alias("n_products"), F.countDistinct("category").alias("n_categories"))
    return sums.withColumn("share", F.col("n_products") / F.sum("n_products").over(Window.partitionBy("k")))


def evaluated_for_models(evaluated: DataFrame, matched: DataFrame, models: list[str]) -> DataFrame:
    """Matches that people have evaluated, beside the matched offers (offer_id, model) of some models."""
    return evaluated.join(matched.filter(F.col("model").isin(models)), "offer_id")
