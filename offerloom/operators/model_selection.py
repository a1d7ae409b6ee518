"""How many trees, which parameters, how many clusters: choices that are made by looking at rows that weren't learned from.

* Boosting stops on the area under the precision-recall curve. All stages of a model are scored in one pass over the validation
  rows; their labels are counted by stage and bucket of score, a table of bounded size, which gives the area of each stage.
* A random search draws different points of a grid. Its folds are dealt evenly inside each label: the cuts between them are exact
  quantiles of a hash, so no label is sorted in one task and a fold's share of a label is equal to one row.
* Clusters are judged by their silhouettes for several k at once: one pass sums the clusters of all k, another one the silhouettes of
  all rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.dataset import seeded
from offerloom.operators.evaluation import class_weight
from offerloom.operators.models import assembled
from offerloom.operators.quantiles import quantiles
from offerloom.sources.scratch import saved

#: Buckets of scores from which an area is computed.
BUCKETS = 4096


@dataclass
class Staged:
    """A boosted model of which the first `stages` trees count, and (stage, area) for all of them."""

    model: GBTClassificationModel
    stages: int
    areas: list[float]


def _with_trees(rows: DataFrame, model: GBTClassificationModel, stages: int) -> tuple[DataFrame, list[Column]]:
    """rows (with features) and each tree's weighted answer."""
    for k, tree in enumerate(model.trees[:stages]):
        rows = tree.setPredictionCol(f"_tree{k}").transform(rows)
    return rows, [F.col(f"_tree{k}") * w for k, w in enumerate(model.treeWeights[:stages])]


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-2 * margin))


def areas(validation: DataFrame, model: GBTClassificationModel, label: str = "label") -> list[float]:
    """The area under the precision-recall curve (average precision over buckets of score) after each tree; 0 without positives."""
    rows, answers = _with_trees(validation, model, len(model.trees))
    upto, margins = F.lit(0.0), []
    for answer in answers:
        upto = upto + answer
        margins.append(upto)
    each = rows.select(F.col(label).cast("int").alias("label"), F.posexplode(F.array(*(F.floor(_probability(m) * BUCKETS) for m in margins))).alias("stage", "bucket"))
    counts = each.groupBy("stage", "bucket").agg(F.sum("label").alias("tp"), F.count("*").alias("n")).collect()  # stages * BUCKETS rows at most
    out = []
    for stage in range(len(model.trees)):
        mine = sorted(((r.bucket, r.tp, r.n) for r in counts if r.stage == stage), reverse=True)
        tp, n = (np.cumsum([x[k] for x in mine], dtype=float) for k in (1, 2))
        out.append(float((np.diff(tp, prepend=0) * tp / n).sum() / tp[-1]) if len(tp) and tp[-1] else 0.0)
    return out


def stop_at(values: list[float], patience: int) -> int:
    """The stage after which nothing better came for `patience` stages, counted from 1."""
    best = 0
    for k, value in enumerate(values):
        if value > values[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1 if values else 0


def train_staged(pairs: DataFrame, features: list[str], validation: str = "is_validation", rounds: int = 20, depth: int = 4, patience: int = 5, seed: int = 1) -> Staged:
    """Weighted boosted trees on the rows that `validation` doesn't mark, stopped by the area on those that it marks."""
    rows = saved(assembled(pairs, features), "training")
    learned, held = rows.filter(~F.col(validation)), rows.filter(F.col(validation))
    weight = class_weight(learned).first()["weight"] or 1.0
    learned = learned.withColumn("weight", F.when(F.col("label") == 1, float(weight)).otherwise(1.0))
    model = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed).fit(learned)
    values = areas(held, model)
    return Staged(model, stop_at(values, patience), values)


def staged_scores(pairs: DataFrame, staged: Staged, features: list[str]) -> DataFrame:
    """pairs with `score`, the probability of label 1 after the stages that count."""
    rows, answers = _with_trees(assembled(pairs, features), staged.model, staged.stages)
    return rows.select(*pairs.columns, _probability(sum(answers, F.lit(0.0))).alias("score"))


def folds(rows: DataFrame, label: str, keys: list[str], n: int, seed: int) -> DataFrame:
    """rows with `fold` (0 to n - 1), dealt evenly inside each label by a seeded hash of the keys. Rows with equal keys share a
    fold; a null label is a label."""
    hashed = rows.withColumn("_h", F.conv(F.substring(seeded(seed, *keys), 1, 12), 16, 10).cast("double"))
    cuts = quantiles(hashed, [label], "_h", [k / n for k in range(1, n)]).select(F.col(label).alias("_label"), F.col("quantiles").alias("_cuts"))
    placed = hashed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_label")))  # as many rows as labels
    return placed.withColumn("fold", F.size(F.filter("_cuts", lambda c: c < F.col("_h")))).drop("_h", "_label", "_cuts")


def draws(space: dict[str, list], n: int, seed: int) -> list[dict]:
    """n different points of a grid at random, all of them if it has no more."""
    names, sizes = list(space), [len(v) for v in space.values()]
    chosen = random.Random(seed).sample(range(prod(sizes)), min(n, prod(sizes)))
    out = []
    for number in chosen:
        point = {}
        for name, size in zip(names, sizes):
            number, at = divmod(number, size)
            point[name] = space[name][at]
        out.append(point)
    return out


def search(pairs: DataFrame, features: list[str], space: dict[str, list], n: int, keys: list[str], n_folds: int = 5, patience: int = 5, seed: int = 1) -> tuple[dict, DataFrame]:
    """(the best point, a table of all): mean area over folds of n random points; a point's parameters are those of train_staged.
    Each fold's model is stopped and judged on the fold itself. Ties: the point drawn first."""
    rows = saved(folds(pairs, "label", keys, n_folds, seed), "folds")
    found = []
    for at, point in enumerate(draws(space, n, seed)):
        for fold in range(n_folds):
            staged = train_staged(rows.withColumn("_held", F.col("fold") == fold), features, "_held", patience=patience, seed=seed, **point)
            found.append((at, str(sorted(point.items())), fold, staged.stages, staged.areas[staged.stages - 1] if staged.areas else 0.0))
    table = pairs.sparkSession.createDataFrame(found, "draw int, point string, fold int, stages int, area double")
    means = {at: sum(f[4] for f in found if f[0] == at) / n_folds for at in {f[0] for f in found}}
    return draws(space, n, seed)[max(means, key=lambda at: (means[at], -at))], table


def silhouettes(rows: DataFrame, vector: str, centres: dict[int, np.ndarray]) -> list[tuple[int, float, list[int]]]:
    """(k, mean silhouette under squared distance, rows of each cluster) for each k; centres: k -> its centres. A row alone in its
    cluster counts as 0. Two passes over the rows, whatever the number of ks; sums are as many as centres."""
    values = rows.select(vector_to_array(vector).alias("x")) if dict(rows.dtypes)[vector] == "vector" else rows.select(F.col(vector).cast("array<double>").alias("x"))
    ks = sorted(centres)

    def nearest(x: np.ndarray, k: int) -> np.ndarray:
        return ((x[:, None, :] - centres[k][None]) ** 2).sum(axis=2).argmin(axis=1)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                yield np.array(batch.column(0).slice(k, 1024).to_pylist(), float)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares, total = ({k: np.zeros(centres[k].shape[:d]) for k in ks} for d in (1, 1, 2))
        for x in parts(batches):
            for k in ks:
                own = nearest(x, k)
                np.add.at(n[k], own, 1)
                np.add.at(squares[k], own, (x**2).sum(axis=1))
                np.add.at(total[k], own, x)
        out = [(k, c, n[k][c], squares[k][c], total[k][c].tolist()) for k in ks for c in range(len(centres[k]))]
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.list_(pa.float64()))], ["k", "c", "n", "squares", "total"])

    each = values.mapInArrow(sums, "k int, c int, n double, squares double, total array<double>")
    added = each.select("k", "c", "n", "squares", F.posexplode("total").alias("d", "v")).groupBy("k", "c", "d").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), F.sum("v").alias("v")).collect()  # centres * dimensions
    n, squares, total = ({k: np.zeros(centres[k].shape[:d]) for k in ks} for d in (1, 1, 2))
    for r in added:
        n[r.k][r.c], squares[r.k][r.c], total[r.k][r.c, r.d] = r.n, r.squares, r.v

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = dict.fromkeys(ks, 0.0)
        for x in parts(batches):
            norm, at = (x**2).sum(axis=1), np.arange(len(x))
            for k in ks:
                own = nearest(x, k)
                held = np.maximum(n[k], 1)
                # the mean squared distance to a cluster's rows, from its sums
                far = norm[:, None] + (squares[k] / held)[None] - 2 * x @ (total[k] / held[:, None]).T
                inside = far[at, own] * n[k][own] / np.maximum(n[k][own] - 1, 1)
                far[:, n[k] == 0] = np.inf
                far[at, own] = np.inf
                other = far.min(axis=1)
                s = np.where((n[k][own] > 1) & np.isfinite(other), (other - inside) / np.maximum(np.maximum(other, inside), 1e-300), 0.0)
                out[k] += float(s.sum())
        yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array([out[k] for k in ks], pa.float64())], ["k", "s"])

    found = {r.k: r.s for r in values.mapInArrow(scores, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()}  # a row for each k
    return [(k, found.get(k, 0.0) / max(float(n[k].sum()), 1.0), n[k].astype(int).tolist()) for k in ks]


def clusters_over(rows: DataFrame, vector: str, ks: list[int], seed: int = 1) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """((k, silhouette, sizes) for k-means with each k, the centres). vector: a vector column."""
    held = saved(rows.select(vector), "vectors")
    centres = {k: np.array(KMeans(k=k, seed=seed, featuresCol=vector).fit(held).clusterCenters()) for k in ks}
    return rows.sparkSession.createDataFrame(silhouettes(held, vector, centres), "k int, silhouette double, sizes array<long>"), centres
