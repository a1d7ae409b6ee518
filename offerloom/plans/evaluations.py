"""Queries over the decision log: its rows are messages of the decisions on all offers, evaluated by the pairing of today."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.operators import log_evaluation, monitoring
from offerloom.plans import base
from offerloom.plans.base import PAIRS, query
from offerloom.sources import catalog

_NOW = "CASE WHEN offer_id[5] < '2' THEN NULL WHEN offer_id[5] < '6' THEN product_id // 2 ELSE product_id END"
#: Decisions with what the log says of them, and today's pairing.
_LOG = f"""RECURSIVE {PAIRS}, e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey % 5 <> 0 AND p_partkey > 1),
a AS (SELECT child, parent FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON e.child = a.parent),
log AS (SELECT o.offer_id, o.time, CASE WHEN o.offer_id[8] = '0' THEN '' WHEN o.offer_id[7] < '8' THEN 'm_1' ELSE 'm_2' END AS model, n_yes, CASE WHEN n_yes = 1 THEN yes_product END AS final, now,
    now IS NOT NULL AS paired, p.category AS now_category, p.product_id IS NOT NULL AS known, coalesce(o.offer_id[6] < 'c' AND p.category = o.category, false) AS category_right, o.offer_id[9] = '0' AS unsupported
  FROM (SELECT *, {_NOW} AS now FROM offers) o JOIN finals f USING (offer_id) LEFT JOIN products p ON p.product_id = o.now)"""
_SHARE = "round(CASE WHEN days >= 3 THEN {a} / nullif({b}, 0)::DOUBLE END, 6)"


def _share(a: str, b: str) -> str:
    return _SHARE.format(a=a, b=b)


def log_of_decisions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(log, offers with their pairing of today, products, merges)."""
    o = catalog.lines(spark, sf_dir).select(F.lower(F.hex("id")).alias("offer_id"), "product_id")
    nibble = lambda k: F.substring("offer_id", k, 1)
    details = F.when(F.col("reason") == "name", "Name match").when(F.col("reason") == "ean", "Ean match").otherwise(F.concat_ws("=", F.lit("score"), "score"))
    text = lambda c: F.col(c).cast("string")
    rows = base.decided(spark, sf_dir, ("product_name",)).groupBy(*base.OF_OFFER).agg(
        *(F.first(c).alias(c) for c in ("name", "category", "time")),
        F.collect_list(F.struct(text("product_id").alias("id"), F.col("product_name").alias("name"), F.col("category").alias("category_id"))).alias("candidates"),
        F.collect_list(F.struct(text("product_id").alias("id"), details.alias("details"), "decision")).alias("comparisons"),
        F.count_if(F.col("decision") == "yes").alias("n_yes"), F.min(F.when(F.col("decision") == "yes", F.col("product_id"))).alias("yes_product"),
    )
    decision = F.when(F.col("n_yes") == 1, "yes").when(nibble(9) == "0", "unsupported_category").otherwise("unknown")
    model = F.when(nibble(8) != "0", F.struct(F.lit("m").alias("name"), F.when(nibble(7) < "8", "1").otherwise("2").alias("version")))
    body = F.struct(
        F.struct(F.col("offer_id").alias("id"), F.col("name").alias("match_name")).alias("item"), "candidates", "comparisons", model.alias("model_info"), decision.alias("final_decision"),
        F.when(F.col("n_yes") == 1, text("yes_product")).alias("final_candidate"), F.when(nibble(6) < "c", F.concat_ws(",", F.lit("other"), "category")).otherwise(F.lit("other")).alias("possible_categories"),
    )
    log = rows.select("offer_id", F.to_json(body).alias("payload"), "time", decision.alias("decision"))
    now = F.when(nibble(5) < "2", F.lit(None)).when(nibble(5) < "6", F.floor(F.col("product_id") / 2)).otherwise(F.col("product_id"))
    products = catalog.products(spark, sf_dir).select("product_id", F.col("category").alias("category_id"))
    part = products.filter("product_id % 5 <> 0 and product_id > 1")
    return log, o.select("offer_id", now.alias("product_id")), products, part.select(F.col("product_id").alias("child"), F.floor(F.col("product_id") / 2).alias("parent"))


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({c: F.round(c, 6) for c, kind in metrics.dtypes if kind == "double"}).drop("enough_days")


_MATCHED = f"""{_LOG}, r AS (SELECT l.*, d.reason, coalesce(now = final OR a.child IS NOT NULL, false) AS correct, (SELECT bool_or(x.product_id = now) FROM named x WHERE x.offer_id = l.offer_id) AS there
  FROM log l JOIN named d ON d.offer_id = l.offer_id AND d.product_id = l.final LEFT JOIN a ON a.child = l.final AND a.parent = l.now WHERE n_yes = 1),
m AS (SELECT coalesce(CASE WHEN grouping(model) = 0 THEN model END, 'total') AS model, count(*) AS n, date_diff('day', min(time), max(time)) AS days, count(*) FILTER (NOT paired) AS n_unpaired, count(*) FILTER (paired) AS n_paired, count(*) FILTER (correct) AS n_correct,
  count(*) FILTER (category_right) AS n_category, count(*) FILTER (paired AND reason = 'name') AS n_by_name, count(*) FILTER (paired AND reason = 'name' AND correct) AS n_by_name_correct, count(*) FILTER (paired AND reason = 'ean') AS n_by_ean,
  count(*) FILTER (paired AND reason = 'ean' AND correct) AS n_by_ean_correct, count(*) FILTER (paired AND NOT correct) AS n_wrong, count(*) FILTER (paired AND NOT correct AND there) AS n_wrong_in_candidates FROM r GROUP BY ROLLUP (model))"""


@query(f"""WITH {_MATCHED} SELECT m.* EXCLUDE days, {_share('n_unpaired', 'n')} AS unpaired_share, {_share('n_correct', 'n_paired')} AS correct_share, {_share('n_category', 'n_paired')} AS category_share, {_share('n_by_name_correct', 'n_by_name')} AS by_name_correct_share,
  {_share('n_by_ean_correct', 'n_by_ean')} AS by_ean_correct_share, {_share('n_wrong_in_candidates', 'n_wrong')} AS wrong_in_candidates_share, {_share('n_correct', 'n')} AS correct_of_all FROM m""")
def matched_log_metrics(spark, sf_dir):
    log, offers, products, merges = log_of_decisions(spark, sf_dir)
    return _rounded(log_evaluation.matched_metrics(log_evaluation.evaluated_matches(log.filter("decision = 'yes'"), offers, products, merges)))


@query(f"""WITH {_LOG}, r AS (SELECT l.*, n_yes > 1 AS several, n_yes > 1 AND names > 0 AS name_several, n_yes > 1 AND eans > 0 AS ean_several, known AND there AS inside, CASE WHEN known THEN d END AS paired_decision FROM log l JOIN
  (SELECT x.offer_id, count(*) FILTER (decision = 'yes' AND reason = 'name') AS names, count(*) FILTER (decision = 'yes' AND reason = 'ean') AS eans, coalesce(bool_or(x.product_id = l.now), false) AS there, max(decision) FILTER (x.product_id = l.now) AS d FROM named x JOIN log l USING (offer_id) GROUP BY 1) USING (offer_id) WHERE n_yes <> 1),
m AS (SELECT coalesce(CASE WHEN grouping(model) = 0 THEN model END, 'total') AS model, count(*) AS n, date_diff('day', min(time), max(time)) AS days, count(*) FILTER (several) AS n_several, count(*) FILTER (name_several) AS n_name, count(*) FILTER (ean_several) AS n_ean, count(*) FILTER (unsupported) AS n_unsupported,
  count(*) FILTER (paired) AS n_paired, count(*) FILTER (paired_decision = 'yes') AS n_yes, count(*) FILTER (paired_decision = 'unknown') AS n_unknown, count(*) FILTER (paired_decision = 'no') AS n_no, count(*) FILTER (category_right) AS n_category,
  count(*) FILTER (paired AND unsupported) AS n_paired_unsupported, count(*) FILTER (unsupported AND category_right) AS n_unsupported_category, count(*) FILTER (inside) AS n_in_candidates FROM r GROUP BY ROLLUP (model))
SELECT m.* EXCLUDE days, {_share('n_several', 'n')} AS several_share, {_share('n_name', 'n_several')} AS name_share, {_share('n_ean', 'n_several')} AS ean_share, {_share('n_unsupported', 'n')} AS unsupported_share, {_share('n_yes', 'n_paired')} AS paired_yes_share, {_share('n_unknown', 'n_paired')} AS paired_unknown_share,
  {_share('n_no', 'n_paired')} AS paired_no_share, {_share('n_category', 'n_paired')} AS category_share, {_share('n_unsupported_category', 'n_paired_unsupported')} AS unsupported_category_share, {_share('n_in_candidates', 'n')} AS in_candidates_share FROM m""")
def unknown_log_metrics(spark, sf_dir):
    log, offers, products, _ = log_of_decisions(spark, sf_dir)
    return _rounded(log_evaluation.unknown_metrics(log_evaluation.evaluated_unknown(log.filter("decision <> 'yes'"), offers, products)))


@query(f"""WITH {_LOG}, w AS (SELECT l.* FROM log l LEFT JOIN a ON a.child = l.final AND a.parent = l.now WHERE n_yes = 1 AND paired AND NOT (now = final OR a.child IS NOT NULL))
SELECT offer_id, w.model, x.product_id::VARCHAR AS candidate, decision, coalesce(x.product_id = now, false) AS is_current FROM w JOIN named x USING (offer_id) WHERE decision = 'yes' OR x.product_id = now""")
def wrong_match_candidates(spark, sf_dir):
    """The candidates to look at of all wrong matches."""
    log, offers, products, merges = log_of_decisions(spark, sf_dir)
    return log_evaluation.problems(log_evaluation.evaluated_matches(log.filter("decision = 'yes'"), offers, products, merges))


@query(f"""WITH {_MATCHED}, c AS (SELECT DISTINCT category FROM products), t AS (SELECT category, CASE WHEN category < 'M' THEN 'm_1' ELSE 'm_2' END AS model, CASE WHEN category LIKE 'S%' THEN 'Staging' ELSE 'Production' END AS stage FROM c),
bad AS (SELECT model FROM m WHERE days >= 3 AND n_correct / n < 0.92), new AS (SELECT category, model, true AS retrain FROM t WHERE stage = 'Production' AND model IN (SELECT model FROM bad))
SELECT * FROM new UNION ALL SELECT c.category, t.model, false FROM c LEFT JOIN t ON t.category = c.category AND stage = 'Production' WHERE c.category IN ('SMALL', 'PROMO') AND c.category NOT IN ('PROMO') AND c.category NOT IN (SELECT category FROM new)""")
def models_switched_off(spark, sf_dir):
    """Categories that are off after the day's alerts: two were off before, one of them has been deployed anew."""
    metrics = matched_log_metrics(spark, sf_dir).select("model", F.col("correct_of_all").alias("correct_share"), "unpaired_share")
    limits = spark.createDataFrame([("correct_share", "below", 0.92, "critical"), ("unpaired_share", "above", 0.2, "warning")], "metric string, direction string, bound double, level string")
    alerts = monitoring.alerts(log_evaluation.long_form(metrics, ["correct_share", "unpaired_share"]), limits)
    categories = catalog.products(spark, sf_dir).select("category").distinct()
    models = categories.select("category", F.when(F.col("category") < "M", "m_1").otherwise("m_2").alias("model"), F.when(F.col("category").startswith("S"), "Staging").otherwise("Production").alias("stage"))
    was_off = lambda *names: categories.filter(F.col("category").isin(*names))
    return log_evaluation.switched_off(alerts, models, was_off("SMALL", "PROMO"), was_off("PROMO"))
