"""Decision logs: merge history, metrics per model, coverage, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.sources.scratch import saved


def merge_ancestors(edges: DataFrame) -> DataFrame:
    """(product_id, ancestor, steps): all products that a product was merged into, over a table (child, parent). Cycles end
    where they close. Round k puts paths of exactly 2^k steps behind all shorter ones, so a chain of n steps takes log2(n)
    rounds, and the last one finds nothing. Each round is a table in the shared folder."""
    first = edges.select(F.col("child").alias("product_id"), F.col("parent").alias("ancestor"), F.lit(1).alias("steps"))
    found = longest = saved(first.filter("product_id <> ancestor").distinct(), "ancestors")
    length = 1
    while True:
        jump = longest.filter(F.col("steps") == length).select(F.col("product_id").alias("ancestor"), F.col("ancestor").alias("_next"))
        up = found.join(jump, "ancestor").filter("_next <> product_id").select("product_id", F.col("_next").alias("ancestor"), (F.col("steps") + length).alias("steps"))
        up = up.groupBy("product_id", "ancestor").agg(F.min("steps").alias("steps"))
        longest = saved(up.join(found, ["product_id", "ancestor"], "left_anti"), "ancestors")
        if longest.isEmpty():
            return found
        found, length = found.unionByName(longest), 2 * length


def evaluated_matches(log: DataFrame, current: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Matched log rows (offer_id, model, final_product, category, by) beside the offer's current pairing: paired, correct (the
    final product or one that it was merged into), category_right."""
    now = current.select("offer_id", F.col("product_id").alias("now"), F.col("category").alias("now_category"))
    rows = log.join(now, "offer_id", "left")
    up = ancestors.select(F.col("product_id").alias("final_product"), F.col("ancestor").alias("now"), F.lit(True).alias("_merged"))
    rows = rows.join(up, ["final_product", "now"], "left")
    return rows.withColumns({
        "paired": F.col("now").isNotNull(),
        "correct": F.coalesce((F.col("now") == F.col("final_product")) | F.col("_merged"), F.lit(False)),
        "category_right": F.coalesce(F.col("now_category") == F.col("category"), F.lit(False)),
    }).drop("_merged")


def matched_metrics(evaluated: DataFrame) -> DataFrame:
    """Per model and in total; shares are null where there is nothing to divide by."""
    paired = F.count_if("paired")
    rows = evaluated.rollup("model").agg(F.count("*").alias("n"), paired.alias("n_paired"), F.count_if("correct").alias("n_correct"), F.count_if("category_right").alias("n_category_right"), F.count_if(F.col("by") == "name").alias("n_by_name"), F.count_if((F.col("by") == "name") & F.col("correct")).alias("n_by_name_correct"))
    return rows.withColumns({
        "model": F.coalesce("model", F.lit("total")),
        "unpaired_share": 1 - F.col("n_paired") / F.col("n"),
        "correct_share": F.when(F.col("n_paired") > 0, F.col("n_correct") / F.col("n_paired")),
    })


def unknown_metrics(rows: DataFrame) -> DataFrame:
    """Per model and in total, over unknown offers (model, n_yes, paired_decision)."""
    out = rows.rollup("model").agg(F.count("*").alias("n"), F.count_if(F.col("n_yes") > 1).alias("n_several_yes"), F.count_if(F.col("paired_decision") == "yes").alias("n_paired_yes"), F.count_if(F.col("paired_decision") == "no").alias("n_paired_no"))
    return out.withColumn("model", F.coalesce("model", F.lit("total")))


def new_product_metrics(decisions: DataFrame, products: DataFrame) -> DataFrame:
    """New-product decisions (offer_id, model, product_id, time) are right if the product that the offer is in now was made after
    the decision. Per model and in total."""
    rows = decisions.join(products.select("product_id", "created"), "product_id", "left")
    right = F.col("time") < F.col("created")
    out = rows.rollup("model").agg(F.count("*").alias("n"), F.count("created").alias("n_resolved"), F.count_if(right).alias("n_right"))
    return out.withColumns({"model": F.coalesce("model", F.lit("total")), "right_share": F.when(F.col("n_resolved") > 0, F.col("n_right") / F.col("n_resolved"))})


def coverage(counts: DataFrame) -> DataFrame:
    """(model, coverage) from (model, outcome, n) with outcomes matched, new and unknown: the share of matched and new, two
    digits, 0 if there is nothing; with a row `total`. A blank model doesn't count."""
    rows = counts.filter("model <> ''").rollup("model").agg(F.sum(F.when(F.col("outcome") != "unknown", F.col("n")).otherwise(0)).alias("_known"), F.sum("n").alias("_n"))
    return rows.select(F.coalesce("model", F.lit("total")).alias("model"), F.when(F.col("_n") > 0, F.round(F.col("_known") / F.col("_n"), 2)).otherwise(0.0).alias("coverage"))


def alerts(metrics: DataFrame, limits: DataFrame, days: int | None = None, least_days: int = 3) -> DataFrame:
    """Rows of metrics (model, metric, value) beyond a limit (metric, direction, bound, level); none for too few days of data."""
    if days is not None and days < least_days:
        metrics = metrics.limit(0)
    beyond = ((F.col("direction") == "below") & (F.col("value") < F.col("bound"))) | ((F.col("direction") == "above") & (F.col("value") > F.col("bound")))
    return metrics.join(F.broadcast(limits), "metric").filter(beyond).select("model", "metric", "value", "level")


def problem_rows(pairs: DataFrame, most: int = 1000) -> DataFrame:
    """Yes candidates and the paired product of at most `most` offers, by model version and offer (a report)."""
    rows = pairs.filter((F.col("decision") == "yes") | (F.col("product_id") == F.col("current")))
    first = rows.select("version", "offer_id").distinct().orderBy("version", "offer_id").limit(most)
    return rows.join(F.broadcast(first), ["version", "offer_id"])


def passes_gate(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """One row: whether every listed metric (metric, least) is there and reaches its limit."""
    return limits.join(metrics, "metric", "left").agg(F.bool_and(F.coalesce(F.col("value") >= F.col("least"), F.lit(False))).alias("passes"))


def routing(routes: DataFrame, default: str, disabled: DataFrame, categories: DataFrame) -> DataFrame:
    """(category, model): the serving model of each category, the default where it has none, null where it is disabled."""
    rows = categories.join(routes, "category", "left").withColumn("model", F.coalesce("model", F.lit(default)))
    off = disabled.select("model", F.lit(True).alias("_off"))
    return rows.join(off, "model", "left").select("category", F.when(F.col("_off").isNull(), F.col("model")).alias("model"))


def live_windows(events: DataFrame, minutes: int, labels: list[str], time_col: str = "ts") -> DataFrame:
    """Counts by time window and labels; for streams, with a watermark set by the caller."""
    return events.groupBy(F.window(time_col, f"{minutes} minutes").alias("w"), *labels).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *labels, "n")


def latest_per_offer(log: DataFrame) -> DataFrame:
    return log.withColumn("_p", F.row_number().over(Window.partitionBy("offer_id").orderBy(F.desc("time"), "event_id"))).filter("_p = 1").drop("_p")


def samples_per_model(log: DataFrame) -> DataFrame:
    return log.groupBy("model").agg(F.count("*").alias("n_samples"))


def product_rows(products: DataFrame, provenance: DataFrame, categories: DataFrame, offers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products with where they come from and their category's flags, offers with name, category and slug of their product).
    Categories are few and broadcast."""
    full = products.join(provenance, "product_id", "left").join(F.broadcast(categories), "category", "left")
    current = products.select("product_id", F.col("name").alias("product_name"), F.col("category").alias("product_category"), F.col("slug").alias("product_slug"))
    return full, offers.join(current, "product_id", "left")


def replayed(evaluated: DataFrame, current: DataFrame, model: str) -> DataFrame:
    """Messages (offer_id, topic, message) of matches (offer_id, product_id) that people have confirmed and that differ from the
    current pairing (offer_id, product_id), or have none."""
    now = current.select("offer_id", F.col("product_id").alias("_now"))
    rows = evaluated.filter("product_id is not null").join(now, "offer_id", "left").filter(~F.col("product_id").eqNullSafe(F.col("_now")))
    body = F.struct(F.col("offer_id").cast("string").alias("id"), F.lit("yes").alias("final_decision"), F.col("product_id").alias("final_product"), F.lit(model).alias("model"))
    return rows.select("offer_id", F.lit("matched").alias("topic"), F.to_json(body).alias("message"))
