"""Queries over candidates, the title corpus, the decision log, models and streams."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions import text
from offerloom.operators import candidates, corpus, decisions, evaluation, merges, model_selection, models, monitoring, pivots, relevance, stems
from offerloom.plans.base import PRODUCTS, query
from offerloom.sources import catalog
from offerloom.sources.scratch import saved, shared_path
from offerloom.streaming import decisions as streaming
from offerloom.streaming import queue

_NEAR = """WITH d AS (SELECT q.vec_id AS query_id, v.vec_id AS vector_id, v.label, q.label AS own, list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) ** 2 AS distance
  FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vector_id) AS place FROM d), near AS (SELECT * FROM r WHERE place <= 10)"""


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = catalog.table(spark, sf_dir, "embeddings")
    return pivots.nearest(e.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("vector_id"), "embedding"), 10)


def _near_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = catalog.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("product_id"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("category"))
    rows = _near(spark, sf_dir).select(F.col("query_id").alias("offer_id"), F.col("vector_id").alias("product_id"), "distance")
    return rows.join(e, "product_id")


@query(_NEAR + " SELECT query_id, vector_id, round(distance, 3) AS distance, place FROM near")
def knn_l2(spark, sf_dir):
    return _near(spark, sf_dir).select("query_id", "vector_id", F.round("distance", 3).alias("distance"), F.col("place").cast("long").alias("place"))


@query("""WITH q AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '')) AS words FROM benchmark),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '') AS words FROM documents), s AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM d),
w AS (SELECT item_id, unnest(words) AS word FROM q), p AS (SELECT doc_id, len(words) AS length, unnest(words) AS word FROM d),
t AS (SELECT word, doc_id, length, count(*) AS tf FROM p WHERE word IN (SELECT word FROM w) GROUP BY ALL), f AS (SELECT word, count(*) AS df FROM t GROUP BY 1),
x AS (SELECT item_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))) AS relevance FROM t JOIN f USING (word) JOIN w USING (word), s GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(relevance, 9) DESC, doc_id) AS place FROM x) SELECT item_id AS query_id, doc_id AS text_id, round(relevance, 4) AS relevance, place FROM r WHERE place <= 5""", "token_candidates_any_script")
def token_candidates(spark, sf_dir):
    return _token_candidates(spark, sf_dir, text.any_script_words(F.col("text")))


def _token_candidates(spark: SparkSession, sf_dir: str, words: Column) -> DataFrame:
    q = catalog.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), words.alias("words"))
    d = catalog.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), words.alias("words"))
    rows = relevance.most_relevant(q, d, 5)
    return rows.select("query_id", "text_id", F.round("relevance", 4).alias("relevance"), F.col("place").cast("long").alias("place"))


@query(_NEAR + """, s AS (SELECT CASE WHEN place <= 5 THEN 'a' ELSE 'b' END AS source, * FROM near), u AS (SELECT * FROM s UNION ALL SELECT 'all', * EXCLUDE source FROM s)
SELECT source, count(*) AS n, count(DISTINCT vector_id) AS n_products, count(DISTINCT query_id) AS n_offers, round(quantile_cont(distance, 0.5), 3) AS median, round(quantile_cont(distance, 0.95), 3) AS high, round(count(*) / count(DISTINCT query_id)::DOUBLE, 6) AS per_offer FROM u GROUP BY 1""")
def candidate_stats(spark, sf_dir):
    rows = _near(spark, sf_dir).select(F.when(F.col("place") <= 5, "a").otherwise("b").alias("source"), F.col("query_id").alias("offer_id"), F.col("vector_id").alias("product_id"), "distance")
    out = candidates.source_statistics(rows)
    return out.select("source", "n", "n_products", "n_offers", F.round(F.get("quantiles", F.lit(3)), 3).alias("median"), F.round(F.get("quantiles", F.lit(5)), 3).alias("high"), F.round("per_offer", 6).alias("per_offer"))


@query(_NEAR + """, o AS (SELECT query_id, min(vector_id) FILTER (place = 3 + query_id % 4) AS current FROM near GROUP BY 1), m AS (SELECT query_id, place FROM near JOIN o USING (query_id) WHERE vector_id = current),
x AS (SELECT o.query_id, 'l2' AS source, place FROM o LEFT JOIN m USING (query_id) UNION ALL SELECT o.query_id, 'best', place FROM o LEFT JOIN m USING (query_id)) SELECT source, coalesce(place, -1) AS rank, count(*) AS n FROM x GROUP BY 1, 2""")
def paired_rank(spark, sf_dir):
    near = _near(spark, sf_dir)
    offers = near.groupBy("query_id").agg(F.min(F.when(F.col("place") == 3 + F.col("query_id") % 4, F.col("vector_id"))).alias("product_id")).withColumnRenamed("query_id", "offer_id")
    rows = near.select(F.lit("l2").alias("source"), F.col("query_id").alias("offer_id"), F.col("vector_id").alias("product_id"), "distance")
    return candidates.paired_rank(rows, offers).withColumn("rank", F.col("rank").cast("long"))


@query(_NEAR + """, w AS (SELECT query_id, 'c' || label::VARCHAR AS category, sum(greatest(200.0::DOUBLE - distance, 0)) AS w FROM near GROUP BY 1, 2), s AS (SELECT *, w / nullif(sum(w) OVER (PARTITION BY query_id), 0) AS share FROM w),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY share DESC, category) AS p FROM s WHERE share IS NOT NULL) SELECT query_id AS offer_id, category, round(share, 6) AS share FROM best WHERE p = 1""")
def category_estimate(spark, sf_dir):
    rows = _near_candidates(spark, sf_dir).withColumn("relevance", F.lit(None).cast("double"))
    return candidates.top_category(candidates.category_estimate(rows, 200.0)).withColumn("share", F.round("share", 6))


@query(_NEAR + """, a AS (SELECT query_id AS offer_id, vector_id AS product_id, distance, CAST(NULL AS DOUBLE) AS relevance, 'l2' AS source FROM near UNION ALL SELECT query_id, vector_id, NULL, 10.0 - place, 'text' FROM near WHERE place % 2 = 0 UNION ALL SELECT query_id, vector_id + 1, NULL, 1.0, 'text' FROM near WHERE place = 1)
SELECT offer_id, product_id, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources, round(min(distance), 3) AS distance, min(relevance) AS relevance FROM a GROUP BY 1, 2""")
def merged_candidates(spark, sf_dir):
    near = _near(spark, sf_dir)
    l2 = near.select(F.col("query_id").alias("offer_id"), F.col("vector_id").alias("product_id"), "distance")
    even = near.filter("place % 2 = 0").select(F.col("query_id").alias("offer_id"), F.col("vector_id").alias("product_id"), (10.0 - F.col("place")).alias("relevance"))
    next_ = near.filter("place = 1").select(F.col("query_id").alias("offer_id"), (F.col("vector_id") + 1).alias("product_id"), F.lit(1.0).alias("relevance"))
    rows = candidates.merged([("l2", l2), ("text", even.unionByName(next_).groupBy("offer_id", "product_id").agg(F.min("relevance").alias("relevance")))])
    return rows.select("offer_id", "product_id", F.array_join("sources", "|").alias("sources"), F.round("distance", 3).alias("distance"), "relevance")


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '')"


@query(f"""WITH t AS (SELECT {_WORDS} AS w FROM documents), s AS (SELECT unnest(w) AS word FROM t), c AS (SELECT word, count(*) AS n FROM s GROUP BY 1), g AS (SELECT unnest(list_zip(w[:-2], w[2:])) AS p FROM t WHERE len(w) > 1),
b AS (SELECT p[1] AS first, p[2] AS second, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 10), x AS (SELECT first, second, b.n, log2(b.n * (SELECT sum(n) FROM c)::DOUBLE / (u.n * v.n::DOUBLE)) AS pmi FROM b JOIN c u ON u.word = first JOIN c v ON v.word = second)
SELECT first, second, n, round(pmi, 5) AS pmi FROM x WHERE pmi > 4""", "collocations_any_script")
def collocations_pmi(spark, sf_dir):
    return _collocations(spark, sf_dir, text.any_script_words(F.col("text")))


def _collocations(spark: SparkSession, sf_dir: str, words: Column) -> DataFrame:
    return corpus.collocations(catalog.table(spark, sf_dir, "documents"), words, 10, 4.0).withColumn("pmi", F.round("pmi", 5))


@query(f"""WITH t AS (SELECT lang, unnest({_WORDS}) AS word FROM documents), c AS (SELECT lang AS category, word, count(*) AS n FROM t GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, word) AS place FROM c) SELECT category, word, n, place FROM r WHERE place <= 25""", "characteristic_words_any_script")
def characteristic_words(spark, sf_dir):
    return _characteristic_words(spark, sf_dir, text.any_script_words(F.col("text")))


def _characteristic_words(spark: SparkSession, sf_dir: str, words: Column) -> DataFrame:
    rows = catalog.table(spark, sf_dir, "documents").select(F.col("lang").alias("category"), words.alias("words"))
    return corpus.characteristic_words(rows, 25).withColumn("place", F.col("place").cast("long"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey % 5 <> 0 AND p_partkey > 1), a AS (SELECT child, parent, 1 AS steps FROM e UNION ALL SELECT a.child, e.parent, steps + 1 FROM a JOIN e ON e.child = a.parent)
SELECT child AS product_id, parent AS ancestor, min(steps) AS steps FROM a GROUP BY 1, 2""")
def merge_ancestors(spark, sf_dir):
    return monitoring.merge_ancestors(_edges(spark, sf_dir))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = catalog.table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0 and p_partkey > 1")
    return part.select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).alias("parent"))


_LOG = """log AS (SELECT event_id, ts AS time, 'm_' || (user_id % 4)::VARCHAR AS model, event_type, value, user_id, CASE event_type WHEN 'click' THEN 'matched' WHEN 'view' THEN 'matched' WHEN 'purchase' THEN 'new' ELSE 'unknown' END AS outcome FROM events)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decisions: the model by user, the outcome by kind."""
    outcome = F.when(F.col("event_type").isin("click", "view"), "matched").when(F.col("event_type") == "purchase", "new").otherwise("unknown")
    return catalog.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("time"), F.concat(F.lit("m_"), (F.col("user_id") % 4).cast("string")).alias("model"), "event_type", "value", "user_id", outcome.alias("outcome"))


@query(f"""WITH {_LOG} SELECT coalesce(model, 'total') AS model, round(count(*) FILTER (outcome <> 'unknown') / count(*)::DOUBLE, 2) AS coverage FROM log GROUP BY ROLLUP (model)""")
def coverage(spark, sf_dir):
    return monitoring.coverage(_log(spark, sf_dir).groupBy("model", "outcome").agg(F.count("*").alias("n")))


@query(f"""WITH {_LOG}, c AS (SELECT coalesce(model, 'total') AS model, round(count(*) FILTER (outcome <> 'unknown') / count(*)::DOUBLE, 2) AS value FROM log GROUP BY ROLLUP (model)) SELECT model, 'coverage' AS metric, value, 'warning' AS level FROM c WHERE value < 0.75""")
def coverage_alerts(spark, sf_dir):
    rows = coverage(spark, sf_dir).select("model", F.lit("coverage").alias("metric"), F.col("coverage").alias("value"))
    limits = spark.createDataFrame([("coverage", "below", 0.75, "warning"), ("correct_share", "below", 0.92, "critical")], "metric string, direction string, bound double, level string")
    return monitoring.alerts(rows, limits)


@query(f"""WITH RECURSIVE {_LOG}, e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey % 5 <> 0 AND p_partkey > 1),
a AS (SELECT child, parent FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON e.child = a.parent), m AS (SELECT l.*, user_id AS final_product, CASE WHEN event_id % 6 < 5 THEN user_id // (2 ** (event_id % 6))::BIGINT END AS now FROM log l WHERE outcome = 'matched'),
j AS (SELECT m.*, m.now IS NOT NULL AS paired, coalesce(m.now = m.final_product OR a.child IS NOT NULL, false) AS correct FROM m LEFT JOIN a ON a.child = m.final_product AND a.parent = m.now)
SELECT coalesce(model, 'total') AS model, count(*) AS n, count(*) FILTER (paired) AS n_paired, count(*) FILTER (correct) AS n_correct, round(1 - count(*) FILTER (paired) / count(*)::DOUBLE, 6) AS unpaired_share, round(count(*) FILTER (correct) / nullif(count(*) FILTER (paired), 0)::DOUBLE, 6) AS correct_share FROM j GROUP BY ROLLUP (model)""")
def matched_metrics(spark, sf_dir):
    log = _log(spark, sf_dir).filter("outcome = 'matched'").select(F.col("event_id").alias("offer_id"), "model", F.col("user_id").alias("final_product"), F.lit("c").alias("category"), F.lit("name").alias("by"))
    moves = F.col("offer_id") % 6  # products merged up to four times since
    now = log.select("offer_id", F.when(moves < 5, F.floor(F.col("final_product") / F.pow(F.lit(2.0), moves)).cast("long")).alias("product_id"), "category").filter("product_id is not null")
    asked = log.select("offer_id", "final_product").join(now, "offer_id").select(F.col("final_product").alias("product_id"), F.col("product_id").alias("ancestor"))
    rows = monitoring.matched_metrics(monitoring.evaluated_matches(log, now, merges.merged_into(asked, _edges(spark, sf_dir))))
    return rows.select("model", "n", "n_paired", "n_correct", F.round("unpaired_share", 6).alias("unpaired_share"), F.round("correct_share", 6).alias("correct_share"))


@query(f"""WITH {_LOG}, u AS (SELECT model, event_id % 3 AS n_yes, CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'unknown' END AS d FROM log WHERE outcome = 'unknown')
SELECT coalesce(model, 'total') AS model, count(*) AS n, count(*) FILTER (n_yes > 1) AS n_several_yes, count(*) FILTER (d = 'yes') AS n_paired_yes, count(*) FILTER (d = 'no') AS n_paired_no FROM u GROUP BY ROLLUP (model)""")
def unknown_metrics(spark, sf_dir):
    rows = _log(spark, sf_dir).filter("outcome = 'unknown'").select("model", (F.col("event_id") % 3).alias("n_yes"), F.when(F.col("event_id") % 4 == 0, "yes").when(F.col("event_id") % 4 == 1, "no").otherwise("unknown").alias("paired_decision"))
    return monitoring.unknown_metrics(rows)


@query(f"""WITH {_LOG}, o AS (SELECT o_orderkey, o_orderdate FROM orders), d AS (SELECT l.*, o_orderdate AS created FROM log l LEFT JOIN o ON o.o_orderkey = l.event_id % 20000 WHERE outcome = 'new')
SELECT coalesce(model, 'total') AS model, count(*) AS n, count(created) AS n_resolved, count(*) FILTER (time < created) AS n_right, round(count(*) FILTER (time < created) / nullif(count(created), 0)::DOUBLE, 6) AS right_share FROM d GROUP BY ROLLUP (model)""")
def new_product_metrics(spark, sf_dir):
    made = catalog.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("product_id"), F.col("o_orderdate").alias("created"))
    rows = _log(spark, sf_dir).filter("outcome = 'new'").select("model", "time", (F.col("event_id") % 20000).alias("product_id"))
    return monitoring.new_product_metrics(rows, made).withColumn("right_share", F.round("right_share", 6))


@query(f"""WITH {_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time DESC, event_id) AS p FROM log) SELECT user_id, event_id, outcome FROM r WHERE p = 1""")
def latest_decisions(spark, sf_dir):
    rows = _log(spark, sf_dir).withColumn("offer_id", F.col("user_id"))
    return monitoring.latest_per_offer(rows).select("user_id", "event_id", "outcome")


@query(f"""WITH {_LOG} SELECT time_bucket(INTERVAL 60 minutes, time) AS start, model, outcome, count(*) AS n FROM log GROUP BY 1, 2, 3""")
def decision_windows(spark, sf_dir):
    return monitoring.live_windows(_log(spark, sf_dir), 60, ["model", "outcome"], "time")


@query("""WITH l AS (SELECT min(value) AS low FROM events) SELECT CASE WHEN value < 0 THEN 0 WHEN value >= 100 THEN 21 ELSE floor(value / 5)::BIGINT + 1 END AS bucket, count(*) AS n FROM events GROUP BY 1""")
def value_histogram(spark, sf_dir):
    return streaming.histogram(catalog.table(spark, sf_dir, "events"), "value", 0.0, 100.0, 20)


@query("""WITH s AS (SELECT d.doc_id, quality AS label, (n_chars % 1000) / 1000.0::DOUBLE AS score FROM documents d JOIN labels USING (doc_id)), e AS (SELECT score, sum(label) AS tp, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT score, sum(tp) OVER w AS tp, sum(n) OVER w AS n, (SELECT sum(label) FROM s) AS every FROM e WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), p AS (SELECT score, tp / n::DOUBLE AS precision, tp / every::DOUBLE AS recall FROM c)
SELECT score, round(precision, 6) AS precision, round(recall, 6) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1 FROM p""")
def pr_curve(spark, sf_dir):
    d = catalog.table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 1000 / 1000.0).alias("score"))
    rows = evaluation.pr_points(d.join(catalog.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id"))
    return rows.select("score", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("""SELECT count(*) FILTER (quality = 1) AS n_positive, count(*) FILTER (quality = 0) AS n_negative, round(count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1)::DOUBLE, 6) AS weight FROM labels""")
def class_weight(spark, sf_dir):
    return evaluation.class_weight(catalog.table(spark, sf_dir, "labels"), "quality").withColumn("weight", F.round("weight", 6))


@query("""WITH c AS (SELECT label AS category, vec_id % 7 AS cluster, count(*) AS n FROM embeddings GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY category)::DOUBLE AS share FROM c),
l AS (SELECT *, coalesce(share - lead(share) OVER w, 1) AS lead, row_number() OVER w AS p FROM s WINDOW w AS (PARTITION BY category ORDER BY n DESC, cluster)) SELECT category, cluster, n, round(share, 6) AS share, round(lead, 6) AS lead FROM l WHERE p = 1""")
def category_clusters(spark, sf_dir):
    rows = catalog.table(spark, sf_dir, "embeddings").select(F.col("label").alias("category"), (F.col("vec_id") % 7).alias("cluster"))
    return evaluation.assigned_clusters(rows).withColumns({c: F.round(c, 6) for c in ("share", "lead")})


@query("""SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts)::DATE - 28 FROM events) AND ts < (SELECT max(ts)::DATE - 14 FROM events)""")
def evaluation_window(spark, sf_dir):
    log = catalog.table(spark, sf_dir, "events")
    last = log.agg(F.max("ts").cast("date").cast("string").alias("d")).first()["d"]
    return catalog.evaluation_window(log, "ts", last).select("event_id", "user_id")


@query("""SELECT event_id, event_type FROM events ORDER BY md5('11|' || event_id::VARCHAR || '|' || event_type), event_id, event_type LIMIT 200""")
def random_log_rows(spark, sf_dir):
    return catalog.log_rows(catalog.table(spark, sf_dir, "events"), "ts", "1900-01-01", "2200-01-01", ["event_id", "event_type"], 200, 11)


@query(f"""WITH c AS (SELECT DISTINCT p_type AS category FROM part), r AS (SELECT category, CASE WHEN category < 'M' THEN 'm_a' END AS model FROM c) SELECT category, nullif(coalesce(model, 'm_default'), 'm_default') AS model FROM r""")
def model_routing(spark, sf_dir):
    c = catalog.table(spark, sf_dir, "part").select(F.col("p_type").alias("category")).distinct()
    routes = c.filter("category < 'M'").withColumn("model", F.lit("m_a"))
    return monitoring.routing(routes, "m_default", spark.createDataFrame([("m_default",)], "model string"), c)


@query(f"""WITH {_LOG} SELECT event_id AS offer_id, CASE outcome WHEN 'matched' THEN 'matched' WHEN 'new' THEN 'new-product' ELSE 'unknown' END AS topic FROM log WHERE user_id % 10 <> 0""")
def stream_decisions(spark, sf_dir):
    """Events as a stream of offers: those that the catalogue has are decided batch by batch and written to topics."""
    source = catalog.table(spark, sf_dir, "events")
    out = shared_path(spark, "topics")
    known = source.filter("user_id % 10 <> 0").select(F.col("event_id").alias("offer_id"))

    def decide(batch: DataFrame) -> DataFrame:
        found, _ = streaming.split_batch(batch.withColumnRenamed("event_id", "offer_id"), known)
        outcome = F.when(F.col("event_type").isin("click", "view"), "yes").when(F.col("event_type") == "purchase", "no").otherwise("unknown")
        return found.select("offer_id", decisions.topic(outcome, F.lit("")).alias("topic"))

    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "*.parquet").parquet(_stream_folder(spark, sf_dir))
    streaming.run_batches(stream, decide, out, shared_path(spark, "progress")).awaitTermination()
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").select("offer_id", "topic")


def _stream_folder(spark: SparkSession, sf_dir: str) -> str:
    """The event table as a stream's source folder."""
    folder = shared_path(spark, "source")
    catalog.table(spark, sf_dir, "events").write.parquet(folder)
    return folder


_TRIES, _MINUTES = 3, 2 * 24 * 60
_GONE = f"s.came IS NOT NULL AND e.ms >= s.came + {_MINUTES * 60_000}"
_HELD = f"s.came IS NOT NULL AND e.ms < s.came + {_MINUTES * 60_000}"


@query(f"""WITH RECURSIVE e AS (SELECT user_id, ms, kind, row_number() OVER (PARTITION BY user_id ORDER BY ms, kind) AS r FROM (
    SELECT user_id, epoch_us(ts) // 1000 AS ms, CASE event_type WHEN 'view' THEN 'new' WHEN 'signup' THEN 'new' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS kind FROM events)),
s AS (SELECT DISTINCT user_id, 0::BIGINT AS r, NULL::INT AS tries, NULL::BIGINT AS came, NULL::VARCHAR AS action, NULL::INT AS told, NULL::BIGINT AS ms, NULL::INT AS lost, NULL::BIGINT AS lost_at FROM e
  UNION ALL SELECT user_id, e.r, CASE WHEN {_HELD} THEN CASE WHEN kind = 'new' THEN s.tries WHEN kind = 'failed' AND s.tries < {_TRIES} THEN s.tries + 1 END WHEN kind = 'new' THEN 1 END,
    CASE WHEN {_HELD} THEN CASE WHEN kind = 'new' OR kind = 'failed' AND s.tries < {_TRIES} THEN s.came END WHEN kind = 'new' THEN e.ms END,
    CASE WHEN {_HELD} THEN CASE kind WHEN 'done' THEN 'done' WHEN 'failed' THEN CASE WHEN s.tries < {_TRIES} THEN 'retry' ELSE 'dropped' END END WHEN kind = 'new' THEN 'process' END,
    CASE WHEN {_HELD} THEN CASE WHEN kind = 'failed' AND s.tries < {_TRIES} THEN s.tries + 1 ELSE s.tries END ELSE 1 END, e.ms,
    CASE WHEN {_GONE} THEN s.tries END, CASE WHEN {_GONE} THEN s.came + {_MINUTES * 60_000} END FROM s JOIN e USING (user_id) WHERE e.r = s.r + 1),
last AS (SELECT user_id, max(r) AS r FROM s GROUP BY 1)
SELECT user_id AS offer_id, action, told AS tries, epoch_ms(ms) AS at FROM s WHERE action IS NOT NULL UNION ALL SELECT user_id, 'dropped', lost, epoch_ms(lost_at) FROM s WHERE lost_at IS NOT NULL
UNION ALL SELECT user_id, 'dropped', s.tries, epoch_ms(s.came + {_MINUTES * 60_000}) FROM s JOIN last USING (user_id, r) WHERE s.came + {_MINUTES * 60_000} <= (SELECT max(ms) FROM e)""")
def retry_queue(spark, sf_dir):
    """The log as events of a queue, in three parts that come one after another, each taken by a run of its own."""
    kind = F.when(F.col("event_type").isin("view", "signup"), "new").when(F.col("event_type") == "purchase", "done").otherwise("failed")
    events = catalog.table(spark, sf_dir, "events").select(F.col("user_id").alias("offer_id"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("ts"))
    low, high = events.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()  # two numbers
    third = F.least(F.floor((F.unix_millis("ts") - low) * 3 / (high - low + 1)), F.lit(2)) if low is not None else F.lit(0)
    folder, out, checkpoint = (shared_path(spark, name) for name in ("events", "actions", "progress"))
    for part in range(3):
        events.filter(third == part).write.mode("append").parquet(folder)
        queue.run(spark.readStream.schema(events.schema).parquet(folder), out, checkpoint, _TRIES, _MINUTES).awaitTermination()
    return spark.read.parquet(out).select("offer_id", "action", "tries", F.col("at").cast("timestamp_ntz").alias("at"))


#: At most so many labelled pairs are learned from, in the order of a hash; all pairs are scored.
TRAINING_PAIRS = 20_000
_TREES = ["price", "name_similarity", "ean_matches", "size_gap"]


@query()
def pair_scores(spark, sf_dir):
    """Boosted trees on labelled pairs, scored over all of them."""
    from offerloom.plans import base

    rows = base.pairs(spark, sf_dir).withColumns({"label": (F.col("product_id") == F.col("current")).cast("int"), "size_gap": F.col("product_size").cast("double")})
    rows = rows.withColumn("is_validation", F.substring(F.md5("offer_id"), 1, 1) < "3")
    rows = saved(rows.select("offer_id", "product_id", "label", "is_validation", *_TREES), "pairs")
    sample = rows.orderBy(F.md5(F.concat("offer_id", F.lit("train"))), "product_id").limit(TRAINING_PAIRS)
    staged = model_selection.train_staged(sample.select("label", "is_validation", *_TREES), _TREES, rounds=8, depth=3, patience=3)
    scored = model_selection.staged_scores(rows.select("offer_id", "product_id", "label", *_TREES), staged, _TREES)
    return scored.select("offer_id", "product_id", "label", F.round("score", 4).alias("score"))


@query("""WITH h AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY ('0x' || substr(md5('7|' || doc_id::VARCHAR), 1, 12))::BIGINT) - 1 AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, ((0.2::DOUBLE * (n - 1) < r)::INT + (0.4::DOUBLE * (n - 1) < r)::INT + (0.6::DOUBLE * (n - 1) < r)::INT + (0.8::DOUBLE * (n - 1) < r)::INT) AS fold FROM h""")
def label_folds(spark, sf_dir):
    """Five folds of the labelled documents, dealt evenly inside each label."""
    return model_selection.folds(catalog.table(spark, sf_dir, "labels"), "quality", ["doc_id"], 5, seed=7).select("doc_id", "quality", "fold")


@query()
def cluster_silhouettes(spark, sf_dir):
    """k-means over all vectors for several k, each with its silhouette and the sizes of its clusters."""
    rows = catalog.table(spark, sf_dir, "embeddings").filter("embedding is not null").select(array_to_vector("embedding").alias("v"))
    return model_selection.clusters_over(rows, "v", [4, 8, 12])[0]


@query()
def document_clusters(spark, sf_dir):
    rows = catalog.table(spark, sf_dir, "documents").select("doc_id", "lang", *text.title_shape(F.col("text")))
    found = models.clusters(rows, ["n_chars", "n_words", "n_digits"], [4])
    k, _, assigned = found[0]
    return evaluation.assigned_clusters(assigned.select(F.col("lang").alias("category"), "cluster"))


@query()
def word_vectors(spark, sf_dir):
    """Per document the mean vector of its words; words without a vector count as zero."""
    rows = catalog.table(spark, sf_dir, "documents").select("doc_id", text.any_script_words(F.col("text")).alias("words"))
    model = models.word_vectors(rows, "words", size=16, least=20)
    return model.learned().select("doc_id", "vector")



def _stem_sql(tokens: str) -> str:
    """The light stemmer over a query of tokens, ending by ending of the published lists. An x of +word is a word to be softened,
    one of -word is ready."""
    def soft(x: str) -> str:
        rules = " ".join(f"WHEN regexp_matches({x}, '{found}$') THEN regexp_replace({x}, '{found}$', '{hard}')" for found, hard in stems.HARDENED)
        return f"CASE {rules} ELSE left({x}, length({x}) - 1) END"

    def cut(x: str, rules: tuple) -> str:
        sign = {stems.HARD: "-", stems.SOFT: "+", stems.BARE: "+"}
        off = lambda how, ending: len(ending) - (how == stems.SOFT)
        each = ((least, how, ending) for least, how, endings in rules for ending in endings)
        return f"CASE {' '.join(f"WHEN length({x}) >= {least} AND ends_with({x}, '{ending}') THEN '{sign[how]}' || left({x}, length({x}) - {off(how, ending)})" for least, how, ending in each)} ELSE '-' || {x} END"

    ready = f"CASE WHEN x[1] = '-' THEN x[2:] ELSE {soft('x[2:]')} END"
    return f"""WITH t AS ({tokens}), a AS (SELECT token, {cut('token', stems.CASES)} AS x FROM t), b AS (SELECT token, {ready} AS w FROM a), c AS (SELECT token, {cut('w', stems.POSSESSIVES)} AS x FROM b)
SELECT token, {ready} AS stem FROM c"""


@query(_stem_sql("SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS token FROM part"))
def token_stems(spark, sf_dir):
    """Stems of the vocabulary of product names and categories."""
    names = catalog.table(spark, sf_dir, "part").select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("token"))
    return stems.stemmed(names.distinct())


@query(_stem_sql(f"SELECT DISTINCT unnest({_WORDS}) AS token FROM documents"))
def document_stems(spark, sf_dir):
    tokens = catalog.table(spark, sf_dir, "documents").select(F.explode(text.any_script_words(F.col("text"))).alias("token"))
    return stems.stemmed(tokens.distinct())


@query(f"""WITH {_LOG}, m AS (SELECT model, count(*)::DOUBLE AS n, round(avg(value), 4) AS mean FROM log GROUP BY 1) SELECT model AS source, 'n' AS statistic, n AS value FROM m UNION ALL SELECT model, 'mean', mean FROM m""")
def long_metrics(spark, sf_dir):
    from offerloom.sources import sinks

    rows = _log(spark, sf_dir).groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))
    return sinks.long_metrics(rows, "model")
