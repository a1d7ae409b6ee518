"""Evaluation of logged decisions: hand-made rows, missing parts, gates of days, and what follows from alerts."""

import json

import pytest
from pyspark.sql import functions as F

from offerloom.operators import log_evaluation as le
from offerloom.operators import monitoring

CATEGORIES = {10: "a", 11: "a", 12: "b", 13: "a", 14: None}


def payload(final, candidates, model=("m", "1"), possible="a,b", decision="yes"):
    """candidates: id -> (decision, details)."""
    return json.dumps({
        "item": {"id": "x", "match_name": "x"}, "candidates": [{"id": str(c), "name": "n", "category_id": "a"} for c in candidates], "model_info": model and {"name": model[0], "version": model[1]},
        "comparisons": [{"id": str(c), "details": d[1], "decision": d[0]} for c, d in candidates.items()], "final_decision": decision, "final_candidate": final and str(final), "possible_categories": possible,
    })


YES = {10: ("yes", "Name match, x=1"), 11: ("no", "score=0.1")}
MATCHED = [
    (1, payload(10, YES), "2024-01-01 00:00:00"),  # right
    (2, payload(10, YES), "2024-01-02 00:00:00"),  # merged into 12, then 13
    (3, payload(10, YES), "2024-01-03 00:00:00"),  # in another candidate
    (4, payload(10, {10: ("yes", "Ean match"), 12: ("yes", "s")}, possible="c"), "2024-01-04 00:00:00"),  # in no candidate
    (5, payload(10, YES), "2024-01-05 00:00:00"),  # unpaired
    (6, payload(10, YES), "2024-01-05 00:00:00"),  # not in the catalogue
    (7, payload(11, {11: ("yes", "score=1")}, model=None), "2024-01-05 00:00:00"),  # without a model
    (8, None, "2024-01-05 00:00:00"),
]
NOW = [(1, 10), (2, 13), (3, 11), (4, 14), (5, None), (7, 11), (8, 10)]


@pytest.fixture(scope="module")
def tables(spark):
    offers = spark.createDataFrame(NOW, "offer_id long, product_id long")
    products = spark.createDataFrame(list(CATEGORIES.items()), "product_id long, category_id string")
    return offers, products, spark.createDataFrame([(10, 12), (12, 13)], "child long, parent long")


def log(spark, rows):
    return spark.createDataFrame(rows, "offer_id long, payload string, t string").select("offer_id", "payload", F.to_timestamp("t").alias("time"))


def test_matches(spark, tables):
    rows = le.evaluated_matches(log(spark, MATCHED), *tables)
    flags = ("paired", "correct", "by_name", "by_ean", "correct_category", "in_candidates", "n_problems")
    got = {int(r.offer_id): tuple(int(r[f]) for f in flags) for r in rows.collect()}
    assert got == {1: (1, 1, 1, 0, 1, 1, 0), 2: (1, 1, 1, 0, 1, 1, 0), 3: (1, 0, 1, 0, 1, 1, 2), 4: (1, 0, 0, 1, 0, 0, 2), 5: (0, 0, 1, 0, 0, 0, 0), 7: (1, 1, 0, 0, 1, 1, 0), 8: (1, 0, 0, 0, 0, 0, 0)}
    assert sorted((r.offer_id, r.candidate, r.decision, r.is_current) for r in le.problems(rows).collect()) == [("3", "10", "yes", False), ("3", "11", "no", True), ("4", "10", "yes", False), ("4", "12", "yes", False)]
    metrics = {r.model: r for r in le.matched_metrics(rows).collect()}
    assert set(metrics) == {"m_1", "", "total"}
    m = metrics["m_1"]
    assert (m.n, m.n_unpaired, m.n_correct, m.n_by_name, m.n_by_name_correct, m.n_by_ean, m.n_by_ean_correct, m.n_wrong) == (5, 1, 2, 3, 2, 1, 0, 2)
    assert (m.unpaired_share, m.correct_share, m.category_share, m.wrong_in_candidates_share, m.correct_of_all) == (0.2, 0.5, 0.75, 0.5, 0.4)
    assert metrics[""].enough_days is False and metrics[""].correct_share is None  # rows of one day
    assert metrics["total"].n == 7 and le.matched_metrics(rows, least_days=5).filter("correct_share is not null").count() == 0
    assert le.matched_metrics(rows.limit(0)).filter("n > 0").count() == 0


def test_unknown(spark, tables):
    several = {10: ("yes", "Name match"), 11: ("yes", "Ean match"), 14: ("no", "s")}
    rows = [
        (1, payload(None, several, decision="unknown"), "2024-01-01 00:00:00"),
        (3, payload(None, {10: ("yes", "Name match"), 11: ("unknown", "s")}, decision="unknown"), "2024-01-03 00:00:00"),
        (4, payload(None, several, possible="", decision="unsupported_category"), "2024-01-05 00:00:00"),
        (5, payload(None, {}, decision="unsupported_category"), "2024-01-05 00:00:00"),
        (6, payload(None, several), "2024-01-05 00:00:00"),
    ]
    out = le.evaluated_unknown(log(spark, rows), *tables[:2])
    flags = ("paired", "several_yes", "name_in_several", "ean_in_several", "unsupported", "in_candidates")
    got = {int(r.offer_id): (*(int(r[f]) for f in flags), r.paired_decision) for r in out.collect()}
    assert got == {1: (1, 1, 1, 1, 0, 1, "yes"), 3: (1, 0, 0, 0, 0, 1, "unknown"), 4: (1, 1, 1, 1, 1, 1, "no"), 5: (0, 0, 0, 0, 1, 0, None)}
    m = le.unknown_metrics(out).filter("model = 'total'").first()
    assert (m.n, m.several_share, m.name_share, m.unsupported_share, m.in_candidates_share) == (4, 0.5, 1.0, 0.5, 0.75)
    assert (round(m.paired_yes_share, 6), round(m.category_share, 6), m.unsupported_category_share) == (0.333333, 0.666667, 0.0)
    assert le.problems(out).count() == 4 + 1  # offer 4 is in 14, which said no


def test_alerts_and_what_follows(spark):
    metrics = spark.createDataFrame([("m_1", 0.9, 0.1), ("m_2", 0.95, 0.3), ("m_3", 0.5, None), ("total", 0.91, 0.1)], "model string, correct_of_all double, unpaired_share double")
    limits = spark.createDataFrame([("correct_of_all", "below", 0.92, "critical"), ("unpaired_share", "above", 0.2, "warning")], "metric string, direction string, bound double, level string")
    alerts = monitoring.alerts(le.long_form(metrics, ["correct_of_all", "unpaired_share"]), limits)
    assert sorted((r.model, r.level) for r in alerts.collect()) == [("m_1", "critical"), ("m_2", "warning"), ("m_3", "critical"), ("total", "critical")]
    models = spark.createDataFrame([("c1", "m_1", "Production"), ("c2", "m_2", "Production"), ("c3", "m_3", "Staging"), ("c4", "m_4", "Production"), ("c5", "m_1", "Production")], "category string, model string, stage string")
    names = lambda *x: spark.createDataFrame([(c,) for c in x], "category string")
    off = le.switched_off(alerts, models, names("c4", "c5", "c9", "c2"), names("c2", "c1"))
    assert sorted(map(tuple, off.collect()), key=str) == [("c1", "m_1", True), ("c4", "m_4", False), ("c5", "m_1", True), ("c9", None, False)]
