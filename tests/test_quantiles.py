"""Exact quantiles by refined intervals, against sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.operators import quantiles

AT = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("buckets, sent", [(1024, 100_000), (2, 0)])
def test_against_sorting(spark, monkeypatch, buckets, sent):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "MOST_SENT", sent)
    rng = random.Random(1)
    groups = {
        "normal": [rng.gauss(0, 1) for _ in range(1500 if buckets > 2 else 60)],
        "ties": [float(rng.randint(0, 3)) for _ in range(500)],
        "wide": [1e308, -1e308, 5e-324, 0.0, -0.5, 1.0],
        "next": [1.0, np.nextafter(1.0, 2.0), 1.0],
        "one": [7.5],
        None: [1.0, 2.0],
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("none", float("nan")), ("one", float("inf")), ("one", None)]
    got = {r.k: r.quantiles for r in quantiles.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", AT).collect()}
    assert set(got) == {*groups, "none"} and got["none"] is None
    for k, vs in groups.items():
        want = []
        for q in AT:
            vs, spot = sorted(vs), (len(vs) - 1) * q
            low, high = vs[int(np.floor(spot))], vs[int(np.ceil(spot))]
            want.append(low if low == high else low * (np.ceil(spot) - spot) + high * (spot - np.floor(spot)))
        assert got[k] == pytest.approx(want, rel=1e-12, abs=0), k


def test_as_spark_says(spark):
    rows = spark.range(5000).select(F.pmod("id", F.lit(3)).alias("k"), F.pmod(F.col("id") * 7919, F.lit(1000)).alias("v"))
    got = quantiles.quantiles(rows, ["k"], "v", AT).collect()
    want = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, AT))).alias("q")).collect()}
    assert {r.k: r.quantiles for r in got} == {k: pytest.approx(v) for k, v in want.items()}
    assert quantiles.quantiles(rows.limit(0), ["k"], "v", AT).count() == 0
