"""Clustering of vectors around centroids, in whole numbers, with nearest centroids found by the threshold algorithm.

Each dimension has its centroids in a sorted list. For a vector the lists are walked outward from its own value, all at the
same pace, the nearer side first. A centroid that comes up in any list gets its exact distance. The squared gaps to what comes
next in each list sum up to a bound for all centroids that haven't come up: once it is strictly above the best distance, no
other can be nearer, nor as near with a smaller number, and the walk ends.

Vectors are a table in the shared folder; a round sends the centroids (their number is a parameter) to all tasks and gets
sums per cluster and dimension back, as many rows as centroids have components. Sums and quotients are exact.

A vector counts if it has the asked number of components, none null, NaN or infinite; others are left out. Its components
become floor(scale * x). Repeated vectors count each time; a null id is hashed as the empty string; vectors with one id are
ordered by their components. With fewer vectors than centroids each is a centroid; an empty table gives no rows. Numbers
beyond 64-bit arithmetic are computed as Python's whole numbers; a distance or sum of distances beyond a long is its largest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.common import saved

#: Vectors that are walked at once, and bits of a summand that leaves a task (sums of many fit 38 digits).
AT_ONCE, LIMB = 1024, 80
_MOST = 2**63 - 1


def most_narrow(dims: int) -> int:
    """Components up to this size have distances and sums that 64 bits hold."""
    return min(2**31 - 1, math.isqrt(2**62 // dims) // 2 - 1)


def whole(values: list[float], scale: int) -> list[int]:
    """floor(scale * x) of each component, exactly."""
    return [math.floor(y) if math.isfinite(y := scale * x) else scale * int(x) for x in values]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of the nearest centroid for each row of x, ties to the smaller number, and how many
    distances were computed. Both of one dtype, int64 within most_narrow or object."""
    m, (k, dims) = len(x), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, 0)
    far = 2 * max(abs(int(f(a))) for a in (x, centroids) for f in (np.min, np.max)) + 1  # beyond any gap
    high = np.stack([np.searchsorted(values[:, d], x[:, d]) for d in range(dims)], axis=1)
    low, at = high - 1, np.arange(dims)
    who, best = np.full(m, k), np.full(m, far * far * dims, x.dtype)
    seen, computed = np.zeros((m, k), bool), 0

    def gaps(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lows, highs = low[rows], high[rows]
        below = np.where(lows >= 0, x[rows] - values[np.maximum(lows, 0), at], far)
        return below, np.where(highs < k, values[np.minimum(highs, k - 1), at] - x[rows], far)

    rows = np.arange(m)
    below, above = gaps(rows)
    while len(rows):
        down = below <= above
        came = np.where(down, order[np.maximum(low[rows], 0), at], order[np.minimum(high[rows], k - 1), at])
        low[rows] -= down
        high[rows] += ~down
        fresh = np.zeros((len(rows), k), bool)
        fresh[np.arange(len(rows))[:, None], came] = True
        fresh &= ~seen[rows]
        seen[rows] |= fresh
        i, c = np.nonzero(fresh)
        computed += len(i)
        distance = np.full((len(rows), k), far * far * dims, x.dtype)
        distance[i, c] = ((x[rows[i]] - centroids[c]) ** 2).sum(axis=1)
        number = distance.argmin(axis=1)
        least = distance[np.arange(len(rows)), number]
        better = (least < best[rows]) | ((least == best[rows]) & (number < who[rows]))
        who[rows[better]], best[rows[better]] = number[better], least[better]
        below, above = gaps(rows)
        frontier = (np.minimum(below, above) ** 2).sum(axis=1)
        going = ~((frontier > best[rows]).astype(bool) | seen[rows].all(axis=1))
        rows, below, above = rows[going], below[going], above[going]
    return who, best, computed


def kept_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, narrow, wide): components as little-endian 32-bit integers, or as text if one of them is larger."""
    most = most_narrow(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, AT_ONCE) for k in range(0, batch.num_rows, AT_ONCE)):
                right = part.filter(pc.fill_null(pc.equal(pc.list_value_length(part.column(1)), dims), False))
                flat = pc.cast(right.column(1).flatten(), pa.float64())
                x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
                finite = np.isfinite(x).all(axis=1)
                right, x = right.filter(pa.array(finite)), x[finite]
                scaled = np.floor(scale * np.clip(x, -most, most))  # exact for all that isn't clipped
                small = (np.abs(scale * np.clip(x, -most, most)) <= most - 1).all(axis=1)
                narrow = [row.tobytes() if s else None for row, s in zip(scaled.astype("<i8").astype("<i4"), small)]
                wide = [None if s else ",".join(map(str, whole(row.tolist(), scale))) for row, s in zip(x, small)]
                yield pa.RecordBatch.from_arrays([right.column(0), pa.array(narrow, pa.binary()), pa.array(wide, pa.string())], ["id", "narrow", "wide"])

    id_type = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, f"id {id_type}, narrow binary, wide string")


def _components(narrow: bytes | None, wide: str | None) -> list[int]:
    return np.frombuffer(narrow, "<i4").tolist() if narrow is not None else list(map(int, wide.split(",")))


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch: places of the rows, their components, nearest centroids and distances."""
    dims = len(centroids[0])
    small = all(max(map(abs, c)) <= most_narrow(dims) for c in centroids)
    narrow, wide = batch.column("narrow"), batch.column("wide")
    is_wide = np.asarray(wide.is_valid().to_numpy(zero_copy_only=False), bool)
    for rows, dtype in ((np.nonzero(~is_wide)[0], np.int64 if small else object), (np.nonzero(is_wide)[0], object)):
        held = np.array(centroids, dtype)
        for k in range(0, len(rows), AT_ONCE):
            part = rows[k : k + AT_ONCE]
            if dtype is np.int64:
                x = np.frombuffer(b"".join(narrow.take(pa.array(part)).to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)
            else:
                x = np.array([_components(narrow[int(i)].as_py(), wide[int(i)].as_py()) for i in part], object)
            number, distance, _ = nearest(x, held)
            yield part, x, number, distance


def _limbs(total: int) -> list[int]:
    """Summands of a number in base 2**LIMB, the last with its sign."""
    out = []
    while not -(2**LIMB) < total < 2**LIMB:
        out.append(total & (2**LIMB - 1))
        total >>= LIMB
    return [*out, total]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: each the floor of the mean of its vectors; one without vectors stays."""
    k, dims = len(centroids), len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            for _, x, number, _ in _assigned(batch, centroids):
                for c in np.unique(number):
                    mine = x[number == c]
                    count[c] += len(mine)
                    total[c] = [a + int(b) for a, b in zip(total[c], mine.sum(axis=0))]
        rows = [(c, d, limb, Decimal(part)) for c in range(k) if count[c] for d, t in ((-1, count[c]), *enumerate(total[c])) for limb, part in enumerate(_limbs(t))]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cluster", "dim", "limb", "total"])

    parts = kept.select("narrow", "wide").mapInArrow(sums, "cluster int, dim int, limb int, total decimal(38,0)")
    out, count, total = [list(c) for c in centroids], [0] * k, [[0] * dims for _ in range(k)]
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("total").alias("total")).collect():  # as many rows as components
        value = int(r["total"]) << (LIMB * r["limb"])
        if r["dim"] < 0:
            count[r["cluster"]] += value
        else:
            total[r["cluster"]][r["dim"]] += value
    for c in range(k):
        if count[c]:
            out[c] = [t // count[c] for t in total[c]]
    return out


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(digest.alias("digest"), "narrow", "wide").orderBy("digest", "narrow", "wide").limit(k).collect()  # k rows
    return [_components(None if r["narrow"] is None else bytes(r["narrow"]), r["wide"]) for r in rows]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of each vector that counts, the final centroids)."""
    spark = vectors.sparkSession
    kept = saved(kept_vectors(vectors, dims, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(kept, k, seed)
    schema = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        return spark.createDataFrame([], schema), []
    for _ in range(rounds):
        centroids = moved(kept, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, number, distance in _assigned(batch, centroids):
                ids = batch.column("id").take(pa.array(part))
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array([min(int(d), _MOST) for d in distance], pa.int64())], [id_col, "cluster", "distance"])

    return saved(kept.mapInArrow(assign, schema), "clusters"), centroids


def with_inertia(clustered: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256, from one row per centroid."""
    spark = clustered.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row per centroid
    told = [(c, min(s, _MOST), min(sum(sums.values()), _MOST), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    each = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clustered.join(F.broadcast(each), "cluster")
