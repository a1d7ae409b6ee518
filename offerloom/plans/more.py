"""Queries over single steps: parsing, dictionaries, guards, versions, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import text
from offerloom.operators import candidates, corpus, dataset, evaluation, features, monitoring
from offerloom.plans import base
from offerloom.plans.base import OFFERS, PAIRS, PRODUCTS, query
from offerloom.sources import catalog, snapshots
from offerloom.sources.scratch import shared_path


@query("""SELECT doc_id, length(text) AS n_chars, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS n_words, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits FROM documents""")
def title_shapes(spark, sf_dir):
    d = catalog.table(spark, sf_dir, "documents")
    return d.select("doc_id", *(c.cast("long").alias(n) for c, n in zip(text.title_shape(F.col("text")), ("n_chars", "n_words", "n_digits"))))


@query(f"""WITH {PRODUCTS} SELECT product_id, 'https://shop.example/' || lower(category) || '/' || replace(lower(name), ' ', '-') || '/' AS url FROM products""")
def product_urls(spark, sf_dir):
    p = catalog.products(spark, sf_dir)
    return p.select("product_id", text.product_url(F.lower("category"), F.replace(F.lower("name"), F.lit(" "), F.lit("-"))).alias("url"))


@query("""SELECT event_id, event_type AS kind, round(value, 2) AS prediction FROM events""")
def detail_numbers(spark, sf_dir):
    """Numbers and names written into a details text, and read from it again."""
    e = catalog.table(spark, sf_dir, "events")
    details = e.select("event_id", F.concat(F.lit("kind="), "event_type", F.lit(",prediction="), F.round("value", 2).cast("decimal(18,2)").cast("string")).alias("d"))
    return details.select("event_id", F.element_at(text.detail_features(F.col("d"), ["kind"]), "kind").alias("kind"), text.detail_number(F.col("d"), "prediction").alias("prediction"))


@query(f"""WITH {PRODUCTS}, t AS (SELECT DISTINCT lower(short_name || ' ' || brand) AS title FROM products), p AS (SELECT DISTINCT string_split(lower(short_name), ' ')[1] || ' ' || string_split(lower(short_name), ' ')[2] AS phrase FROM products WHERE len(string_split(short_name, ' ')) > 1)
SELECT title, CASE WHEN len(string_split(title, ' ')) > 1 AND list_contains((SELECT list(phrase) FROM p), string_split(title, ' ')[1] || ' ' || string_split(title, ' ')[2]) THEN replace(title, string_split(title, ' ')[1] || ' ' || string_split(title, ' ')[2], string_split(title, ' ')[1] || '_' || string_split(title, ' ')[2]) ELSE title END AS phrased
FROM t""")
def phrase_corpus(spark, sf_dir):
    """Titles with the two first words of a short name joined."""
    p = catalog.products(spark, sf_dir)
    words = F.split(F.lower("short_name"), " ")
    phrases = p.filter(F.size(words) > 1).select(F.get(words, F.lit(0)).alias("first"), F.get(words, F.lit(1)).alias("second")).distinct()
    titles = p.select(F.lower(F.concat_ws(" ", "short_name", "brand")).alias("title")).distinct()
    return corpus.phrased(titles, phrases)


@query(f"""WITH {OFFERS}, t AS (SELECT lower(name) AS title FROM products UNION SELECT lower(name) FROM offers), w AS (SELECT title, string_split(title, ' ') AS w FROM t), s AS (SELECT unnest(w) AS word FROM w), c AS (SELECT word, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT title, w, unnest(range(1, len(w))) AS k FROM w), g AS (SELECT title, k, w[k] AS first, w[k + 1] AS second FROM i), b AS (SELECT first, second, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 5),
x AS (SELECT first, second FROM b JOIN c u ON u.word = first JOIN c v ON v.word = second WHERE log2(b.n * (SELECT sum(n) FROM c)::DOUBLE / (u.n * v.n::DOUBLE)) > 1),
h AS (SELECT title, list(first || ' ' || second ORDER BY k) AS found FROM g JOIN x USING (first, second) GROUP BY 1)
SELECT title, CASE WHEN found IS NULL THEN title ELSE list_reduce(list_prepend(title, found), lambda t, p: replace(t, p, replace(p, ' ', '_'))) END AS phrased FROM t LEFT JOIN h USING (title)""")
def collocation_corpus(spark, sf_dir):
    """All titles of products and offers, with the collocations found in them joined."""
    names = [(df.select(F.lower("name").alias("name")), ["name"]) for df in (catalog.products(spark, sf_dir), catalog.offers(spark, sf_dir))]
    titles = corpus.distinct_titles(names)
    return corpus.phrased(titles, corpus.collocations(titles, F.split("title", " "), 5, 1.0))


@query(f"""WITH {PRODUCTS}, d AS (SELECT DISTINCT category, 'brand' AS name, brand AS value, left(brand, 3) AS group_id FROM products), w AS (SELECT product_id, category, unnest(string_split(name, ' ')) AS value FROM products)
SELECT product_id, d.name, count(DISTINCT group_id) AS n_groups FROM w JOIN d USING (category, value) GROUP BY 1, 2""")
def dictionary_matches(spark, sf_dir):
    p = catalog.products(spark, sf_dir)
    entries = p.select("category", F.lit("brand").alias("name"), F.col("brand").alias("value"), F.substring("brand", 1, 3).alias("group_id")).distinct()
    rows = features.dictionary_attributes(p.select("product_id", "category", F.split("name", " ").alias("words")), entries, "product_id", "words")
    return rows.select("product_id", "name", F.size("groups").cast("long").alias("n_groups"))


@query(f"""WITH {PAIRS}, f AS (SELECT category, decision, name_similarity::DOUBLE AS name_similarity FROM named) SELECT decision, count(*) FILTER (name_similarity = 0) AS none, count(*) FILTER (name_similarity = 1.1) AS joined, count(*) FILTER (name_similarity = 1.2) AS sorted, count(*) FILTER (name_similarity = 1.3) AS equal FROM f GROUP BY 1""")
def feature_crosstab(spark, sf_dir):
    rows = base.decided(spark, sf_dir, ("name_similarity",))
    named = {"none": 0.0, "joined": 1.1, "sorted": 1.2, "equal": 1.3}
    return rows.groupBy("decision").agg(*(F.count_if(F.col("name_similarity") == v).alias(k) for k, v in named.items()))


@query(f"""WITH {OFFERS}, d AS (SELECT offer_id AS decision_offer, product_id + (CASE WHEN offer_id[1] < '4' THEN 1 ELSE 0 END) AS final_product, product_id FROM offers)
SELECT decision_offer, final_product, d.product_id, o.offer_id FROM d JOIN offers o ON o.product_id = d.product_id AND o.offer_id <> decision_offer WHERE final_product <> d.product_id""", "every_sibling_offer")
def sibling_offers(spark, sf_dir):
    o = catalog.offers(spark, sf_dir)
    d = o.select("offer_id", (F.col("product_id") + (F.substring("offer_id", 1, 1) < "4").cast("int")).alias("final_product"))
    return dataset.sibling_offers(d, o).select("decision_offer", "final_product", "product_id", "offer_id")


@query(f"""WITH {OFFERS}, e AS (SELECT offer_id FROM offers WHERE offer_id[3] < '6') SELECT offer_id FROM offers WHERE shop % 3 IN (1, 2) AND offer_id NOT IN (SELECT offer_id FROM e)""")
def unverified_machine_pairs(spark, sf_dir):
    o = catalog.offers(spark, sf_dir).withColumn("relation", (F.col("shop") % 3).cast("int"))
    return candidates.unverified_machine_pairs(o, o.filter(F.substring("offer_id", 3, 1) < "6"), [1, 2]).select("offer_id")


@query(f"""WITH {PRODUCTS}, s AS (SELECT DISTINCT category, (size % 3)::INT AS version FROM products WHERE category < 'S'), v AS (SELECT category, max(version) AS v FROM s GROUP BY 1) SELECT DISTINCT category, coalesce(v + 1, 0)::INT AS version FROM products LEFT JOIN v USING (category)""")
def snapshot_versions(spark, sf_dir):
    p = catalog.products(spark, sf_dir)
    have = p.filter("category < 'S'").select("category", (F.col("size") % 3).cast("int").alias("version")).distinct()
    return dataset.next_versions(have, p)


@query(f"""WITH {PRODUCTS} SELECT product_id, category, (category < 'P')::INT AS version FROM products WHERE category < 'P' OR product_id % 3 = 0 AND category <> 'SMALL'""")
def snapshot_rows(spark, sf_dir):
    """The latest version of each category of two snapshots: of a third of the products, then of all in some categories."""
    p, path = catalog.products(spark, sf_dir).select("product_id", "category"), shared_path(spark, "snapshots")
    some = sorted(r.category for r in p.select("category").distinct().collect() if r.category != "SMALL")  # as many rows as categories
    snapshots.write(p.filter("product_id % 3 = 0"), some, path)
    snapshots.write(p, [c for c in some if c < "P"], path)
    return snapshots.read(spark, path, p)


@query(f"""WITH {PRODUCTS}, a AS (SELECT product_id, 0 AS s, 'catalogue' AS store FROM products UNION ALL SELECT product_id, 1, 'preceding' FROM products WHERE product_id % 2 = 0 UNION ALL SELECT product_id, 2, 'test' FROM products WHERE product_id % 6 = 0)
SELECT product_id, arg_max(store, s) AS store FROM a GROUP BY 1""")
def stores_by_precedence(spark, sf_dir):
    p = catalog.products(spark, sf_dir).select("product_id")
    stores = [p.withColumn("store", F.lit("catalogue")), p.filter("product_id % 2 = 0").withColumn("store", F.lit("preceding")), p.filter("product_id % 6 = 0").withColumn("store", F.lit("test"))]
    return dataset.by_precedence(stores, "product_id")


@query(f"""WITH {PRODUCTS}, s AS (SELECT product_id, 1 AS v FROM products WHERE product_id % 2 = 0 UNION ALL SELECT product_id, 0 FROM products WHERE product_id % 3 = 0) SELECT product_id, max(v)::INT AS v FROM s GROUP BY 1""")
def updated_pairs(spark, sf_dir):
    p = catalog.products(spark, sf_dir).select("product_id")
    return dataset.updated(p.filter("product_id % 2 = 0").withColumn("v", F.lit(1)), p.filter("product_id % 3 = 0").withColumn("v", F.lit(0)), ["product_id"])


@query(f"""WITH {PAIRS}, p AS (SELECT status AS version, offer_id, product_id, decision FROM named WHERE decision = 'yes' OR product_id = current), f AS (SELECT DISTINCT version, offer_id FROM p ORDER BY 1, 2 LIMIT 1000) SELECT version, offer_id, product_id, decision FROM p JOIN f USING (version, offer_id)""")
def problem_rows(spark, sf_dir):
    rows = base.decided(spark, sf_dir).withColumn("version", F.col("status"))
    return monitoring.problem_rows(rows).select("version", "offer_id", "product_id", "decision")


@query(f"""WITH {OFFERS} SELECT o.offer_id, p.product_id FROM (SELECT offer_id, category, unnest([product_id, product_id + 1, product_id + 7]) AS product_id FROM offers) o JOIN products p USING (product_id) WHERE o.category > 'D' AND p.category > 'D'""")
def without_long_tail(spark, sf_dir):
    p = catalog.products(spark, sf_dir).select("product_id", "category")
    rows = base.pairs(spark, sf_dir).select("offer_id", "product_id", F.col("category").alias("own")).join(p, "product_id")
    top = rows.select("offer_id", F.col("own").alias("category")).distinct()
    info = p.select("category", (F.col("category") <= "D").alias("long_tail")).distinct()
    return candidates.without_long_tail(rows, top, info)[0].select("offer_id", "product_id")


@query(f"""WITH {PRODUCTS}, a AS (SELECT DISTINCT category, 'size' AS name, size::VARCHAR AS value FROM products), b AS (SELECT * FROM a WHERE value < '3') SELECT category, count(*) AS n_new FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.category = a.category AND b.value = a.value) GROUP BY 1""")
def new_dictionary_values(spark, sf_dir):
    a = catalog.products(spark, sf_dir).select("category", F.lit("size").alias("name"), F.col("size").cast("string").alias("value"))
    return corpus.new_values(a, a.filter("value < '3'"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""", "rows_for_orders")
def rows_for_ids(spark, sf_dir):
    ids = catalog.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return catalog.rows_for_ids(catalog.table(spark, sf_dir, "lineitem"), ids, "l_orderkey").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IS NOT NULL""")
def mostly_missing(spark, sf_dir):
    """A column that is nearly always null leaves."""
    rows = catalog.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, 1).alias("seldom"))
    return evaluation.mostly_missing(rows)


@query(f"""WITH {PAIRS}, f AS (SELECT count(*) FILTER (n_yes = 1 AND yes_product = product_id) / nullif(count(*) FILTER (n_yes = 1), 0)::DOUBLE AS precision, count(*) FILTER (n_yes = 1 OR n_yes = 0 AND n_unknown = 0) / count(*)::DOUBLE AS coverage FROM finals) SELECT precision >= 0.1 AND coverage >= 0.2 AS passes FROM f""")
def redeploy_gate(spark, sf_dir):
    m = evaluation.business_metrics(base.finals(spark, sf_dir)).filter("category = 'all'")
    rows = m.select(F.lit("x").alias("k"), "precision", "coverage").unpivot(["k"], ["precision", "coverage"], "metric", "value")
    return monitoring.passes_gate(rows, spark.createDataFrame([("precision", 0.1), ("coverage", 0.2)], "metric string, least double"))


@query(f"""WITH {PAIRS} SELECT n.offer_id, n.product_id, n.decision, (n.decision = 'yes' AND n.product_id = n.current)::INT AS is_current FROM named n""")
def report_rows(spark, sf_dir):
    rows = base.decided(spark, sf_dir)
    return rows.select("offer_id", "product_id", "decision", ((F.col("decision") == "yes") & (F.col("product_id") == F.col("current"))).cast("int").alias("is_current"))



@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def event_props(spark, sf_dir):
    e = catalog.table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))
