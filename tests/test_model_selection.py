"""Stopping on the area, searching, folds and silhouettes, against plain code."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from offerloom.operators import model_selection as ms
from offerloom.operators.models import assembled


def pairs(spark, n=700):
    rng = random.Random(5)
    rows = []
    for k in range(n):
        a, b, c = rng.random(), rng.random(), rng.random()
        label = int(a + 0.3 * b > 0.9) if rng.random() < 0.8 else int(rng.random() < 0.3)
        rows.append((k, k % 97, a, b, c, label, k % 3 == 0))
    return spark.createDataFrame(rows, "offer_id int, product_id int, a double, b double, c double, label int, is_validation boolean")


def average_precision(scores):
    """From (score, label), ties together."""
    tp = n = out = 0
    groups = {}
    for s, y in scores:
        groups.setdefault(s, []).append(y)
    for s in sorted(groups, reverse=True):
        tp, n = tp + sum(groups[s]), n + len(groups[s])
        out += sum(groups[s]) * tp / n
    return out / sum(y for _, y in scores)


def test_areas_and_loss_stop_apart(spark):
    df = pairs(spark)
    staged = ms.train_staged(df, ["a", "b", "c"], rounds=12, depth=3, patience=12)
    held = df.filter("is_validation")
    for stages in (1, 5, 12):
        scored = ms.staged_scores(held, ms.Staged(staged.model, stages, []), ["a", "b", "c"]).collect()
        assert staged.areas[stages - 1] == pytest.approx(average_precision([(int(r.score * ms.BUCKETS), r.label) for r in scored]))
    whole = ms.staged_scores(held, ms.Staged(staged.model, 12, []), ["a", "b", "c"])
    theirs = {r.offer_id: r.probability[1] for r in staged.model.transform(assembled(held, ["a", "b", "c"])).collect()}
    assert all(theirs[r.offer_id] == pytest.approx(r.score) for r in whole.collect())
    losses = staged.model.evaluateEachIteration(assembled(held, ["a", "b", "c"]).withColumn("weight", F.lit(1.0)))
    assert staged.stages == 1 + int(np.argmax(staged.areas)) and staged.stages != 1 + int(np.argmin(losses))


def test_stop_at():
    assert [ms.stop_at(v, 2) for v in ([], [0.5], [0.1, 0.2, 0.3], [0.3, 0.2, 0.2, 0.9], [0.3, 0.2, 0.4, 0.1, 0.1, 0.9], [0.2, 0.2, 0.2])] == [0, 1, 3, 1, 3, 1]


def test_folds_are_even(spark):
    df = pairs(spark).withColumn("label", F.when(F.col("offer_id") % 50 == 0, None).otherwise(F.col("label")))
    rows = ms.folds(df, "label", ["offer_id", "product_id"], 5, seed=3)
    sizes = Counter((r.label, r.fold) for r in rows.collect())
    assert rows.count() == df.count() and set(rows.columns) == {*df.columns, "fold"}
    for label in (0, 1, None):
        mine = [sizes[label, f] for f in range(5)]
        assert max(mine) - min(mine) <= 1 and min(mine) > 0
    other = {r.offer_id: r.fold for r in ms.folds(df, "label", ["offer_id", "product_id"], 5, seed=4).collect()}
    assert 0.5 < sum(other[r.offer_id] != r.fold for r in rows.collect()) / 700 < 0.95


def test_draws_and_search(spark):
    space = {"depth": [1, 2, 3], "rounds": [2, 4]}
    every = ms.draws(space, 10, 1)
    assert len(every) == 6 and len({tuple(d.items()) for d in every}) == 6 and ms.draws(space, 3, 1) == ms.draws(space, 3, 1) != ms.draws(space, 3, 2)
    best, table = ms.search(pairs(spark, 300), ["a", "b", "c"], space, 2, ["offer_id"], n_folds=2)
    rows = table.collect()
    assert len(rows) == 4 and {r.fold for r in rows} == {0, 1} and all(0.3 < r.area <= 1 for r in rows)
    means = {p: np.mean([r.area for r in rows if r.point == p]) for p in {r.point for r in rows}}
    assert str(sorted(best.items())) == max(means, key=means.get)


def test_silhouettes_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(m, 1, (40, 3)) for m in (0, 4, 9)] + [[[60.0, 0, 0]]])
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(3))
    table, centres = ms.clusters_over(df, "v", [2, 3, 5])
    for r in table.collect():
        own = ((x[:, None] - centres[r.k][None]) ** 2).sum(axis=2).argmin(axis=1)
        far, out = ((x[:, None] - x[None]) ** 2).sum(axis=2), []
        for i in range(len(x)):
            mine = [j for j in range(len(x)) if own[j] == own[i] and j != i]
            other = min(far[i, own == c].mean() for c in set(own) - {own[i]})
            inside = far[i, mine].mean() if mine else 0
            out.append((other - inside) / max(other, inside) if mine else 0)
        assert r.silhouette == pytest.approx(np.mean(out)) and r.sizes == np.bincount(own, minlength=r.k).tolist()
