"""Exact nearest vectors by pivots: only blocks that can hold one of the k nearest are looked at.

1. A bounded sample gives pivots. Each vector belongs to the cell of its nearest pivot, and inside the cell to a ring of
   distances from the pivot; a ring of a cell is a block. Blocks are at most PIVOTS * RINGS whatever the number of vectors,
   with the least and largest distance and the number of their vectors.
2. How near a query can be to any vector of a block follows from its own distances to the pivots: it is at least as far as the
   triangle inequality says of the ring, and as the plane half way between its nearest pivot and the block's pivot.
3. A first round looks at the blocks that are nearest by these bounds until they hold enough vectors. The k-th distance found is
   an upper bound of the k-th of all, so a second round needs only blocks that can be as near.

A block is split into parts of bounded size for many vectors, and its queries for many queries; a part meets its queries in a
task. Vectors are copied only for the further queries of their own block, queries to the blocks that they need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.sources.scratch import saved

#: Vectors that pivots are found from, pivots and rings, vectors of a ring at least, and vectors of the first round.
SAMPLE, PIVOTS, RINGS, RING_ROWS, FIRST = 4096, 128, 16, 256, 1024
#: Vectors and queries that meet in one task, and queries whose distances are computed at once inside it.
VECTOR_ROWS, QUERY_ROWS, AT_ONCE = 4096, 512, 16
#: Bounds are loosened by so much of themselves for what floating point rounds.
ROOM = 1e-9


@dataclass
class Blocks:
    """pivots, and for each block, by number, its cell, its least and largest distance from the pivot, and its vectors."""

    pivots: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    n: np.ndarray

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and block, what the query's distance to any vector of the block can't be below."""
        d = np.sqrt(squared(q, self.pivots))
        own, ring = d.argmin(axis=1), d[:, self.cell]
        apart = np.sqrt(squared(self.pivots, self.pivots))[own][:, self.cell]
        plane = (ring**2 - d.min(axis=1)[:, None] ** 2) / np.where(apart > 0, 2 * apart, np.inf)
        slack = ROOM * (1 + ring + self.high)
        return np.maximum(np.maximum(np.maximum(ring - self.high, self.low - ring), plane) - slack, 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, a few rows at a time."""
    out = np.empty((len(a), len(b)))
    for k in range(0, len(a), AT_ONCE):
        out[k : k + AT_ONCE] = ((a[k : k + AT_ONCE, None, :] - b[None, :, :]) ** 2).sum(axis=2)
    return out


def find_pivots(sample: np.ndarray, most: int, rounds: int = 5) -> np.ndarray:
    """Rows far from each other, moved to the middle of what is nearest to them."""
    if not len(sample):
        return sample
    far, chosen = squared(sample, sample[:1])[:, 0], [0]
    while len(chosen) < min(most, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(sample, sample[chosen[-1:]])[:, 0])
    pivots = sample[chosen]
    for _ in range(rounds):
        own = squared(sample, pivots).argmin(axis=1)
        pivots = np.stack([sample[own == c].mean(axis=0) if (own == c).any() else p for c, p in enumerate(pivots)])
    return np.unique(pivots, axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = np.array(column.to_pylist(), float)
    return rows.reshape(len(column), -1)


def _whole(df: DataFrame, id_col: str) -> DataFrame:
    """Rows whose embedding is there, without null and NaN."""
    return df.select(id_col, F.col("embedding").cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))


def _blocked(vectors: DataFrame, pivots: np.ndarray) -> tuple[DataFrame, Blocks]:
    """((vector_id, v, block) as a saved table, the blocks)."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = squared(_matrix(batch.column(1)), pivots) if batch.num_rows else np.zeros((0, 1))
            yield batch.append_column("cell", pa.array(far.argmin(axis=1), pa.int32())).append_column("far", pa.array(np.sqrt(far.min(axis=1))))

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])
    placed = saved(vectors.mapInArrow(cells, schema), "cells")
    inner = F.array(*(F.lit(k / RINGS) for k in range(1, RINGS)))
    edges = placed.groupBy("cell").agg(F.when(F.count("*") >= RINGS * RING_ROWS, F.percentile_approx("far", inner, 1000)).otherwise(F.array().cast("array<double>")).alias("edges"))
    ringed = placed.join(F.broadcast(edges), "cell").withColumn("ring", F.size(F.filter("edges", lambda e: e < F.col("far"))))  # as many rows as pivots
    rows = ringed.groupBy("cell", "ring").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("n")).orderBy("cell", "ring").collect()  # PIVOTS * RINGS rows at most
    numbers = placed.sparkSession.createDataFrame([(k, r.cell, r.ring) for k, r in enumerate(rows)], "block int, cell int, ring int")
    table = saved(ringed.join(F.broadcast(numbers), ["cell", "ring"]).select("vector_id", "v", "block"), "blocks")
    return table, Blocks(pivots, np.array([r.cell for r in rows], int), *(np.array([r[c] for r in rows], float) for c in ("low", "high")), np.array([r.n for r in rows], int))


def _needs(queries: DataFrame, blocks: Blocks, first: bool, enough: int) -> DataFrame:
    """(query_id, v, block): the blocks of the first round, or (with `reach`, the k-th distance found) the others that a query
    needs."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                bounds = blocks.bounds(_matrix(part.column(1)))
                order = np.argsort(bounds, axis=1, kind="stable")
                before = np.cumsum(blocks.n[order], axis=1) - blocks.n[order]
                mine = np.zeros(bounds.shape, bool)
                np.put_along_axis(mine, order, before < enough, axis=1)
                if not first:
                    reach = part.column(2).fill_null(np.inf).to_numpy(zero_copy_only=False)
                    mine = ~mine & (bounds**2 <= (reach * (1 + ROOM))[:, None])
                row, block = np.nonzero(mine)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(block, pa.int32())], ["query_id", "v", "block"])

    return queries.mapInArrow(choose, T.StructType([*queries.schema.fields[:2], T.StructField("block", T.IntegerType())]))


def _compared(needs: DataFrame, table: DataFrame, blocks: Blocks, k: int) -> DataFrame:
    """(query_id, vector_id, distance): for each query and part of a block that it needs, the k nearest."""
    spark = needs.sparkSession
    asked = {r.block: r.n for r in needs.groupBy("block").agg(F.count("*").alias("n")).collect()}  # a row per block
    facts = [(b, int(-(-blocks.n[b] // VECTOR_ROWS)), -(-n // QUERY_ROWS)) for b, n in asked.items()]
    sizes = F.broadcast(spark.createDataFrame(facts, "block int, parts int, chunks int"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    of = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = needs.join(sizes, "block").select("block", of("query_id", "chunks").alias("chunk"), every("parts").alias("part"), "query_id", "v")
    right = table.join(sizes, "block").select("block", every("chunks").alias("chunk"), of("vector_id", "parts").alias("part"), "vector_id", "v")

    def compare(q: pa.Table, v: pa.Table) -> pa.Table:
        ids = v.column("vector_id").to_numpy()
        far = squared(_matrix(q.column("v").combine_chunks()), _matrix(v.column("v").combine_chunks())) if q.num_rows and v.num_rows else np.zeros((q.num_rows, 0))
        best = [np.lexsort((ids, d))[:k] for d in far]
        at_q = np.repeat(np.arange(len(best)), [len(b) for b in best])
        at_v = np.concatenate(best) if best else np.zeros(0, int)
        return pa.table({"query_id": q.column("query_id").take(pa.array(at_q, pa.int64())), "vector_id": v.column("vector_id").take(pa.array(at_v, pa.int64())), "distance": pa.array(far[at_q, at_v])})

    keys = ["block", "chunk", "part"]
    schema = T.StructType([needs.schema["query_id"], table.schema["vector_id"], T.StructField("distance", T.DoubleType())])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def nearest(queries: DataFrame, vectors: DataFrame, k: int, max_distance: float | None = None) -> DataFrame:
    """Exact k nearest vectors (vector_id, embedding) of queries (query_id, embedding) under squared distance: (query_id, vector_id,
    distance, place), ties by vector id. Query ids are taken as different; embeddings that are null or have a null or NaN have no
    distance and are left out."""
    return explained(queries, vectors, k, max_distance)["result"]


def explained(queries: DataFrame, vectors: DataFrame, k: int, max_distance: float | None = None) -> dict:
    """nearest's result, and n_pairs, the number of distances between queries and vectors that led to it."""
    q = saved(_whole(queries, "query_id"), "queries")
    v = _whole(vectors, "vector_id")
    sample = v.withColumn("_h", F.xxhash64("vector_id")).orderBy("_h").limit(SAMPLE).select("v").collect()  # SAMPLE rows at most
    pivots = find_pivots(np.array([r.v for r in sample], float), PIVOTS)
    kinds = T.StructType([q.schema["query_id"], v.schema["vector_id"], T.StructField("distance", T.DoubleType()), T.StructField("place", T.IntegerType())])
    if not len(pivots) or q.isEmpty():
        return {"result": queries.sparkSession.createDataFrame([], kinds), "n_pairs": 0}
    table, blocks = _blocked(v, pivots)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vector_id"))

    first = saved(_needs(q, blocks, True, max(FIRST, k)), "first-needs")
    found = saved(_compared(first, table, blocks, k).withColumn("place", place).filter(F.col("place") <= k).drop("place"), "first-found")
    reach = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("distance")).alias("reach"))
    if max_distance is not None:
        reach = reach.withColumn("reach", F.least("reach", F.lit(float(max_distance))))
    second = saved(_needs(q.join(reach, "query_id", "left"), blocks, False, max(FIRST, k)), "second-needs")
    numbers = second.unionByName(first).groupBy("block").agg(F.count("*").alias("n")).collect()  # a row per block
    more = found if second.isEmpty() else found.unionByName(_compared(second, table, blocks, k))
    if max_distance is not None:
        more = more.filter(F.col("distance") <= max_distance)
    result = more.withColumn("place", place).filter(F.col("place") <= k)
    return {"result": result, "n_pairs": sum(int(blocks.n[r.block]) * r.n for r in numbers)}
