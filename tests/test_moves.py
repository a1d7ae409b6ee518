"""What the queries over pairs move and write: an offer goes to its product once, and pairs stay there."""

import re

import pytest
from pyspark.sql import functions as F

from offerloom import registry
from offerloom.functions import units
from offerloom.operators import dataset, decisions, evaluation, features, log_evaluation
from offerloom.plans import catalogue, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture
def joined_by_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be sent to all
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", "business_metrics offer_decision pair_outcomes threshold_sweep rerun_status decision_messages report_rows redeploy_gate precision_confidence feature_crosstab".split())
def test_pairs_stay_with_their_product(spark, joined_by_shuffles, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "hashpartitioning(offer_id" not in text
    # lines, their ranges, products, products with ranges, neighbours
    assert text.count("Exchange hashpartitioning(") <= 8


def test_finals_of_pairs(spark):
    rows = [("a", 1, "yes", 1), ("a", 2, "no", 1), ("b", 1, "yes", 2), ("c", 3, "no", 3), ("d", 3, "yes", 3), ("d", 4, "yes", 3), ("e", 4, "unknown", 4)]
    pairs = spark.createDataFrame([(*r, "x") for r in rows], "offer_id string, product_id int, decision string, current int, category string")
    offers = pairs.select("offer_id", "category", F.col("current").alias("product_id"), F.lit(True).alias("is_valid")).distinct()
    want = {tuple(r) for r in decisions.evaluation_decision(offers, pairs).collect()}
    assert {tuple(r) for r in decisions.evaluation_of_pairs(pairs, "current").collect()} == want and ("d", "x", 3, True, "unknown", False) in want
    scored = pairs.withColumn("score", F.when(F.col("decision") != "no", F.col("product_id") / 4))
    a, b = evaluation.threshold_sweep(scored, offers), evaluation.threshold_sweep_of_pairs(scored, "current")
    assert a.orderBy("threshold").collect() == b.orderBy("threshold").collect() and b.first().n == 5
    assert evaluation.threshold_sweep(scored, offers.union(spark.createDataFrame([("f", "x", 9, True)], offers.schema))).first().n == 6


@pytest.mark.parametrize("name", "business_metrics offer_decision rerun_status report_rows precision_confidence pair_outcomes flat_export".split())
def test_no_pairs_are_sorted(spark, joined_by_shuffles, monkeypatch, name):
    """Only lines and products are sorted, by their product; candidates are columns of their offer."""
    monkeypatch.setattr(reports.sinks, "write_flat", lambda rows, path, _: seen.append(rows) or rows.limit(0).write.csv(path))
    seen = []
    text = plan((lambda df: seen[0] if seen else df)(registry.QUERIES[name](spark, SF)))
    assert text.count(", _w0#") < 2 and not re.search(r"Sort \[[^\]]*(offer_id|, )", text)
    assert all(re.fullmatch(r"(product_id|current)#\d+L ASC NULLS FIRST", s) for s in re.findall(r"Sort \[([^\]]*)\]", text))


def test_reports_and_comparisons_move_no_pairs(spark, joined_by_shuffles):
    rows = registry.QUERIES["report_order"](spark, SF)
    assert re.search(r"rangepartitioning\(place#\d+ ASC NULLS FIRST, id#\d+ ASC", plan(rows)) and "offer_id" not in "".join(re.findall(r"Sort \[[^\]]*\]", plan(rows)))
    got = [(r.place, r.offer_id, r.product_id) for r in rows.collect()]
    assert got == sorted(got) and len(got) > 17000
    text = plan(registry.QUERIES["model_comparison"](spark, SF))
    assert "hashpartitioning(offer_id" not in text and "FullOuter" not in text and "finals-" not in text


def test_decisions_in_the_row(spark):
    """The same decisions as over pairs by windows, for offers with up to three candidates and any status."""
    import itertools
    import random

    rng, rows = random.Random(4), []
    for k, n in itertools.product(range(200), (1, 2, 3)):
        rows.append([(k * 4 + n, 10 * k + i, rng.choice((0, 1, 2, 3, 7, None)), rng.choice((None, 0.1, 0.47, 0.9, 0.9)), rng.random() < 0.2, rng.choice((0.0, 1.3)), rng.choice((0, 1)), rng.choice(("ok", "ok", "no", "unknown"))) for i in range(n)])
    names = ["offer_id", "product_id", "status", "score", "price_rejected", "name_similarity", "ean_matches", "quantity"]
    types = ["int", "int", "int", "double", "boolean", "double", "int", "string"]
    schema = lambda of: ", ".join(f"{n} {t}" for n, t in of)
    pairs = spark.createDataFrame([p for o in rows for p in o], schema(zip(names, types))).withColumns({"unique_names": F.lit(True), "ean_required": F.lit(True)})
    want = decisions.with_answers(decisions.name_priority(decisions.status_priority(decisions.pair_decision(pairs).withColumn("first", F.col("decision")), {0: 1, 1: 1, 2: 2, 3: 3}, {3})))
    flat = [(o[0][0], *(v for i in range(3) for v in (o[i][1:] if i < len(o) else (None,) * 7))) for o in rows]
    wide = spark.createDataFrame(flat, schema([("offer_id", "int"), *((f"{n}_{k}", t) for k in range(3) for n, t in zip(names[1:], types[1:]))]))
    of = lambda k, n: F.lit(True) if n in ("unique_names", "ean_required") else F.col(f"{n}_{k}")
    got = decisions.name_priority_in_row(decisions.status_priority_in_row(decisions.decided_in_row(wide, 3, of), 3, {0: 1, 1: 1, 2: 2, 3: 3}, {3}), 3)
    got = decisions.pairs_of_rows(decisions.answers_in_row(got, 3), 3, ["offer_id", "n_yes", "n_unknown", "n", "yes_product"], ["product_id", "reason", "first", "decision"])
    columns = ["offer_id", "product_id", "reason", "first", "decision", "n_yes", "n_unknown", "n", "yes_product"]
    key = lambda df: sorted(map(tuple, df.select(columns).collect()), key=str)
    assert key(got) == key(want) and len({r[2:5] for r in key(want)}) > 8


@pytest.mark.parametrize("name, most", [("report_sections", {"offer_id", "final_decision", "final_product", "several"}), ("flat_export", set())])
def test_reports_write_no_pairs(spark, monkeypatch, name, most):
    seen, write = set(), reports.saved
    monkeypatch.setattr(reports, "saved", lambda df, *a: seen.update(df.columns) or write(df, *a))
    registry.QUERIES[name](spark, SF)
    assert seen <= most


def test_pair_table_moves_no_pairs(spark, joined_by_shuffles):
    text = plan(catalogue._pair_table(spark, SF))
    assert not re.search(r"hashpartitioning\((name#\d+, )?product_name|hashpartitioning\(offer_id", text)


def test_matches_are_saved_without_messages(spark, monkeypatch):
    seen, write = [], log_evaluation.saved
    monkeypatch.setattr(log_evaluation, "saved", lambda df, *a: seen.append(df.columns) or write(df, *a))
    registry.QUERIES["wrong_match_candidates"](spark, SF)
    assert len(seen) == 1 and not {"candidates", "comparisons", "item", "possible_categories"} & set(seen[0])


def test_agreement(spark):
    a = [("x", "1"), ("x", "2"), ("y", None), ("z", "3"), (None, "4")]
    b = [("x", "2"), ("x", "1"), ("y", None), ("z", "5"), (None, "4"), ("w", "1")]
    pairs = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "offer_id int, product_id int")
    of = lambda key, rows: spark.createDataFrame([(1, *r) for r in rows], f"{key} int, name string, value string")
    got = features.attribute_agreement(pairs, of("offer_id", a), of("product_id", b)).collect()
    assert sorted((r.offer_id, r.product_id, r.n_common, r.n_matched, r.any_common, round(r.matched_ratio, 3)) for r in got) == [(1, 1, 3, 1, 1, 0.333)] * 2 + [(1, 2, 0, 0, 0, 0.0), (2, 1, 0, 0, 0, 0.0)]


def test_conflict_as_of_tables(spark):
    q = [("a", "kg", [], "1"), ("a", "kg", [], "2"), ("a", "m", [], "3"), ("b", "kg", [], "1"), ("c", "kg", [], "5"), ("d", "m", ["2"], "3"), ("e", "l", [], "1")]
    table = spark.createDataFrame(q, "k string, unit string, multipliers array<string>, number string")
    keys = spark.createDataFrame([(k,) for k in "abcdef"], "k string")
    pairs = keys.select(F.col("k").alias("x")).join(keys.select(F.col("k").alias("y")))
    want = {tuple(r) for r in units.conflicts(pairs, table.withColumnRenamed("k", "x"), table.withColumnRenamed("k", "y"), "x", "y").select("x", "y", "quantity").collect()}
    t = units.by_title(table, "k")
    side = lambda k: t.select(F.col("k").alias(k), F.col("quantities").alias(f"q{k}"))
    rows = pairs.join(side("x"), "x", "left").join(side("y"), "y", "left")
    assert {tuple(r) for r in rows.select("x", "y", units.conflict(F.col("qx"), F.col("qy"))).collect()} == want and {w[2] for w in want} == {"ok", "no", "unknown"}


def test_other_offers_by_one_move(spark, joined_by_shuffles):
    o = spark.createDataFrame([(1, 1, 7, None), (2, 1, 7, 5), (3, 2, 8, 5), (4, None, 7, 5)], "offer_id int, product_id int, shop int, ean int")
    pairs = spark.createDataFrame([(1, 1, 1, 7, None), (2, 1, 1, 7, 5), (3, 2, 2, 8, 5), (3, 1, 2, 8, 5), (1, 3, 1, 7, None), (4, None, None, 7, 5)], "offer_id int, product_id int, current int, shop int, ean int")
    rows = features.others_have_each(pairs, o, {"shop": "s", "ean": "e"})
    assert {(r.offer_id, r.product_id): (r.s, r.s_known, r.e, r.e_known) for r in rows.filter("product_id is not null").collect()} == {(1, 1): (1, 1, 0, 1), (2, 1): (1, 1, 0, 0), (3, 2): (0, 0, 0, 0), (3, 1): (0, 1, 1, 1), (1, 3): (0, 0, 0, 0)}
    # lines and products come together; after that the pairs and offers go to their product once
    text = plan(registry.QUERIES["leave_one_out_features"](spark, SF))
    assert "hashpartitioning(product_id#" in text and not re.search(r"hashpartitioning\(product_id#\d+L?, [a-z]", text)


def test_labelled_pairs_that_know_their_product(spark, joined_by_shuffles):
    o = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "offer_id int, product_id int")
    c = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (3, 1), (3, 9), (2, 1)], "offer_id int, product_id int")
    want = {(1, 1, 1), (2, 1, 1), (3, 2, 1), (3, 1, 0), (3, 9, 0)}
    known = c.join(o.withColumnRenamed("product_id", "own"), "offer_id")
    for rows in (c, known):
        got = [tuple(r) for r in dataset.labelled_pairs(o, rows, 2).collect()]
        assert len(got) == len(want) and set(got) == want
    assert "hashpartitioning(offer_id#" not in plan(registry.QUERIES["labelled_pairs"](spark, SF)).replace("hashpartitioning(offer_id#", "(own", 1)


def test_collocations_count_words_once(spark, monkeypatch, joined_by_shuffles):
    from offerloom.operators import corpus

    seen, write = [], corpus.saved
    monkeypatch.setattr(corpus, "saved", lambda df, *a: seen.append(df) or write(df, *a))
    titles = spark.createDataFrame([("a b c",), ("a b",), ("c d",), ("",)], "title string")
    rows = corpus.collocations(titles, F.split("title", " "), 2, 0.0)
    assert [(r.first, r.second, r.n, round(r.pmi, 4)) for r in rows.collect()] == [("a", "b", 2, 2.0)] and len(seen) == 1
    assert plan(corpus.collocations(titles, F.split("title", " "), 2, 0.0)).count("Generate explode") == 1  # pairs only
    assert corpus.collocations(titles.limit(0), F.split("title", " ")).count() == 0
