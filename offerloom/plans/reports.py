"""Queries over what is written and read again (reports, exports, feature files), token predicates, named pipelines and live counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions import text, units
from offerloom.operators import decisions
from offerloom.plans import base
from offerloom.plans.base import PAIRS, PRODUCTS, query
from offerloom.sources import catalog, sinks
from offerloom.sources.scratch import saved, shared_path
from offerloom.streaming import decisions as streaming

_FINAL = "CASE WHEN n_yes = 1 THEN 'yes' WHEN n_yes = 0 AND n_unknown = 0 THEN 'no' ELSE 'unknown' END"


@query(f"""WITH {PAIRS} SELECT {_FINAL} AS section, offer_id, CASE WHEN n_yes = 1 THEN yes_product END AS final_product FROM finals UNION ALL SELECT 'several', offer_id, NULL FROM finals WHERE n_yes > 1""")
def report_sections(spark, sf_dir):
    """A report with a section for each decision and one for offers with several yes, read again section by section."""
    rows = base.answered(spark, sf_dir)
    final = saved(rows.select("offer_id", decisions.served().alias("final_decision"), F.when(F.col("n_yes") == 1, F.col("yes_product")).alias("final_product"), (F.col("n_yes") > 1).alias("several")), "decided")
    path = shared_path(spark, "report")
    sections = {d: final.filter(F.col("final_decision") == d).select("offer_id", "final_product") for d in ("yes", "no", "unknown")} | {"several": final.filter("several").select("offer_id", "final_product")}
    sinks.write_sections(sections, path)
    return reduce(DataFrame.union, (spark.read.schema("offer_id string, final_product long").parquet(f"{path}/{name}").select(F.lit(name).alias("section"), "offer_id", "final_product") for name in sections))


@query(f"""WITH {PAIRS} SELECT n.offer_id, {_FINAL} AS final_decision, n.product_id, n.decision, n.reason FROM named n JOIN finals USING (offer_id)""")
def flat_export(spark, sf_dir):
    """Offers and their candidates as tab-separated text, read again."""
    rows, path = base.answered(spark, sf_dir), shared_path(spark, "export")
    flat = decisions.pairs_of_rows(rows.withColumn("final_decision", decisions.served()), len(base.STEPS), ["offer_id", "final_decision"], ["product_id", "decision", "reason"])
    sinks.write_flat(flat, path, "gzip")
    return spark.read.schema("offer_id string, final_decision string, product_id long, decision string, reason string").option("sep", "\t").option("header", True).csv(path)


@query("""SELECT doc_id AS offer_id, quality AS label, toxic AS flag FROM labels""")
def feature_files(spark, sf_dir):
    """Features from several files with a header, one of them without rows."""
    labels, path = catalog.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("offer_id"), F.col("quality").alias("label"), F.col("toxic").alias("flag")), shared_path(spark, "features")
    parts = {"even": labels.filter("offer_id % 2 = 0"), "odd": labels.filter("offer_id % 2 <> 0"), "none": labels.limit(0)}
    for name, part in parts.items():
        part.write.option("header", True).csv(f"{path}/{name}")
    return catalog.read_features(spark, [f"{path}/{name}" for name in parts], labels.schema)


@query("""WITH w AS (SELECT time_bucket(INTERVAL 60 minutes, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT * FROM w WHERE start + INTERVAL 60 minutes <= (SELECT max(ts) FROM events) - INTERVAL 190 minutes""")
def closed_windows(spark, sf_dir):
    """Live counts of a stream: windows that no late event can change any more."""
    events, folder, out = catalog.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), shared_path(spark, "events"), shared_path(spark, "windows")
    events.write.parquet(folder)
    counts = streaming.live_counts(spark.readStream.schema(events.schema).parquet(folder), ["event_type"])
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_path(spark, "progress")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(out).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(f"""WITH {PRODUCTS}, m AS (SELECT product_id FROM products ORDER BY md5('5|' || product_id::VARCHAR), product_id LIMIT 1) SELECT p.product_id, category, row_number() OVER (ORDER BY p.product_id) - 1 AS number, p.product_id = m.product_id AS picked FROM products p, m ORDER BY p.product_id LIMIT 100""")
def numbered_products(spark, sf_dir):
    """The first hundred products with their numbers (a report), and whether one is the product picked at random."""
    p = catalog.products(spark, sf_dir).select("product_id", "category")
    one = catalog.pick_one(p, "product_id", 5).select(F.col("product_id").alias("chosen"))
    rows = catalog.numbered(p, "product_id", 100).withColumn("number", F.col("number").cast("long"))
    return rows.join(F.broadcast(one), F.col("product_id") == F.col("chosen"), "left").select("product_id", "category", "number", F.col("chosen").isNotNull().alias("picked"))  # one row


@query(f"""WITH {PRODUCTS} SELECT product_id, category FROM products WHERE category IN ('LARGE', 'SMALL')""")
def products_of_categories(spark, sf_dir):
    return catalog.of_categories(catalog.products(spark, sf_dir), ["LARGE", "SMALL"], "category").select("product_id", "category")


@query("""SELECT DISTINCT 'e' || lower(p_name || ' ' || p_brand) AS title FROM part""")
def processed_titles(spark, sf_dir):
    """Titles through a configured pipeline of named steps."""
    steps = text.pipeline(["lower", "ascii", "white_space_tokens", "join"])
    titles = catalog.table(spark, sf_dir, "part").select(F.concat(F.lit("É"), "p_name", F.lit("  "), "p_brand").alias("t")).distinct()
    return titles.select(steps(F.col("t")).alias("title")).distinct()


@query("""WITH t AS (SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_brand || ' ' || p_size::VARCHAR || 'kg ' || (p_partkey % 90)::VARCHAR || 'ab'), ' ')) AS token FROM part),
f AS (SELECT *, length(token) < 3 AS short, regexp_matches(token, '^[0-9]+kg') AS quantity, len(regexp_extract_all(token, '[0-9]')) AS digits, len(regexp_extract_all(token, '[a-z]')) AS letters FROM t)
SELECT token FROM f WHERE NOT short AND NOT quantity AND NOT (digits > 0 AND letters < 3 * digits)""")
def kept_tokens(spark, sf_dir):
    """Tokens that collocations are looked for among: neither short nor quantities nor mostly digits."""
    part = catalog.table(spark, sf_dir, "part")
    title = F.lower(F.concat_ws(" ", "p_name", "p_brand", F.concat(F.col("p_size").cast("string"), F.lit("kg")), F.concat((F.col("p_partkey") % 90).cast("string"), F.lit("ab"))))
    token = F.col("token")
    return part.select(F.explode(F.split(title, " ")).alias("token")).distinct().filter(~(text.too_short(token) | text.starts_with_quantity(token) | text.mostly_digits(token)))


@query("""SELECT CASE WHEN a.p_size = b.p_size THEN 'ok' WHEN a.p_partkey % 2 = 0 THEN 'unknown' ELSE 'no' END AS quantity, count(*) AS n FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 GROUP BY 1""")
def attribute_quantities(spark, sf_dir):
    """Conflicts of quantities where every other product has its neighbour's quantity among its attributes as well."""
    p = catalog.products(spark, sf_dir).select("product_id", "size", F.concat_ws(" ", "short_name", F.concat(F.col("size").cast("string"), F.lit("kg"))).alias("title"))
    mine = units.quantities(text.normalised(p, "title", "t"), "product_id", "t")
    attribute = p.select((F.col("product_id") - 1).alias("product_id"), F.lit("kg").alias("unit"), F.col("size").cast("string").alias("number")).filter("product_id % 2 = 0")
    both = units.with_attribute_quantities(mine, attribute)
    pairs = p.select(F.col("product_id").alias("a"), (F.col("product_id") + 1).alias("b")).join(p.select(F.col("product_id").alias("b")), "b")
    out = units.conflicts(pairs, both.withColumnRenamed("product_id", "a"), mine.withColumnRenamed("product_id", "b"), "a", "b")
    return out.groupBy("quantity").agg(F.count("*").alias("n"))
