"""Skip-gram word vectors, learned in parts of the texts that tasks take side by side."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.sources.scratch import saved

#: A stage has this many times the parts of the one before it, and starts from what was learned there.
GROWTH = 8
#: Words that are learned from at once, noise words that these share, noise words that count for each pair, length of a step.
BLOCK, SHARED, NOISE, STEP = 512, 64, 5, 0.2


@dataclass
class WordVectors:
    """words[i] has the vector vectors[i]. `texts` are the titles learned from, with the ids of their words."""

    column: str
    words: pa.Array
    vectors: np.ndarray
    parts: int
    texts: DataFrame

    def getNumPartitions(self) -> int:
        return self.parts

    def getVectors(self) -> DataFrame:
        table = pa.table({"word": self.words, "v": _lists(self.vectors.astype(np.float64))})
        return self.texts.sparkSession.createDataFrame(table).select("word", array_to_vector("v").alias("vector"))

    def transform(self, titles: DataFrame) -> DataFrame:
        """titles with `vector`, the mean vector of their words, instead of the words; words without a vector count as zero."""
        return self._means(_numbered(titles, self.column, self.words, 1))

    def learned(self) -> DataFrame:
        """transform() of the titles learned from; their words aren't cut and looked up again."""
        return self._means(self.texts)

    def _means(self, texts: DataFrame) -> DataFrame:
        sent = texts.sparkSession.sparkContext.broadcast(self.vectors)
        fields = [f for f in texts.schema.fields if f.name not in _ADDED]

        def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vectors = np.vstack([sent.value, np.zeros((1, sent.value.shape[1]), np.float32)])  # id -1 finds the zeros at the end
            for b in batches:
                ids, at = _flat(b.column("ids"))
                n, sums = np.diff(at), np.zeros((b.num_rows, vectors.shape[1]))
                for k in np.flatnonzero(n):
                    sums[k] = vectors[ids[at[k]:at[k + 1]]].sum(axis=0, dtype=np.float64) / n[k]
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), _lists(sums)], [*(f.name for f in fields), "vector"])

        return texts.mapInArrow(means, T.StructType([*fields, T.StructField("vector", T.ArrayType(T.DoubleType()))]))


_ADDED = {"ids": T.ArrayType(T.IntegerType()), "part": T.IntegerType(), "place": T.LongType()}


def learn(titles: DataFrame, words: str, size: int, window: int, least: int, rounds: int, parts: int, seed: int = 1) -> WordVectors:
    """Vectors of the words that are met `least` times or more. A pair of words at most `window` apart is told from pairs with noise
    words. Every part is learned from once in each round; in the first one the number of parts grows from stage to stage."""
    counted = titles.select(words).mapInArrow(_count, "word string, n long").filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = counted.filter(F.col("n") >= least).select("word").toArrow().column("word").combine_chunks().sort()
    texts = saved(_numbered(titles, words, vocabulary, parts), "texts")
    state = np.zeros((len(vocabulary), 2 * size + 2), np.float32)
    state[:, :size] = (np.random.default_rng(seed).random((len(vocabulary), size), np.float32) - 0.5) / size
    stages = [*_stages(parts), *[(0, parts)] * (rounds - 1)] if len(vocabulary) else []
    for k, (first, end) in enumerate(stages):
        mine = texts.filter(F.col("part").between(first, end - 1)).select("ids", "place", (F.col("part") - first).alias("part"))
        wanted = state.shape[1] if k + 1 < len(stages) else size  # what neighbours are good for ends with the last stage
        _learn_stage(mine.repartitionById(end - first, "part").sortWithinPartitions("place"), state, size, window, wanted, [seed, k])
    return WordVectors(words, vocabulary, state[:, :size].copy(), parts, texts)


def _stages(parts: int) -> Iterator[tuple[int, int]]:
    first, n = 0, 1
    while first < parts:
        yield first, min(first + n, parts)
        first, n = first + n, n * GROWTH


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(b.column(0).flatten().value_counts().flatten(), ["word", "n"])


def _numbered(titles: DataFrame, words: str, vocabulary: pa.Array, parts: int) -> DataFrame:
    """titles with the ids of their words instead of the words, -1 for one outside the vocabulary, dealt to parts in turn."""
    sent = titles.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [f for f in titles.schema.fields if f.name != words]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for b in batches:
            each, at = _flat(b.column(words))
            each = each.dictionary_encode()
            ids = pc.fill_null(pc.index_in(each.dictionary, value_set=sent.value).take(each.indices), -1)
            turn = np.arange(done, done + b.num_rows)
            done += b.num_rows
            added = [pa.ListArray.from_arrays(pa.array(at), ids), pa.array(((task + turn) % parts).astype(np.int32)), pa.array((task << 33) + turn)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *added], [*(f.name for f in fields), *_ADDED])

    return titles.mapInArrow(number, T.StructType([*fields, *(T.StructField(n, t) for n, t in _ADDED.items())]))


def _learn_stage(texts: DataFrame, state: np.ndarray, size: int, window: int, wanted: int, seed: list[int]) -> None:
    """Each partition is learned from; the first `wanted` columns of a word's row in the state become the mean of what its parts say,
    by how often they met it."""
    sent = texts.sparkSession.sparkContext.broadcast(state)

    def learn_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, text, n = [], [], 0
        for b in batches:
            ids, at = _flat(b.column("ids"))
            ids = ids.to_numpy()
            met.append(ids[ids >= 0])
            text.append(np.repeat(np.arange(n, n + b.num_rows, dtype=np.int32), np.diff(at))[ids >= 0])
            n += b.num_rows
        if sum(map(len, met)):
            words, count, rows = learned_part(np.concatenate(met), np.concatenate(text), sent.value, size, window, [*seed, TaskContext.get().partitionId()])
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(count), _lists(rows[:, :wanted])], ["id", "met", "row"])

    # a part has a word once: nothing to add up before rows are moved
    rows = texts.mapInArrow(learn_part, "id int, met long, row array<float>").repartition("id")
    sums = [F.sum(F.col("met") * F.get("row", F.lit(i))) for i in range(wanted)]
    found = rows.groupBy("id").agg(F.array(*((s / F.sum("met")).cast("float") for s in sums)).alias("row")).toArrow()
    sent.unpersist()
    state[found.column("id").to_numpy(), :wanted] = found.column("row").combine_chunks().flatten().to_numpy().reshape(-1, wanted)


def learned_part(met: np.ndarray, text: np.ndarray, state: np.ndarray, size: int, window: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, how often each is met, their rows of `state` after learning) from the ids met one after the other and the text of each.
    A row has a word's vector, its vector as a neighbour, and the mean squares of all slopes of either so far."""
    count = np.bincount(met, minlength=len(state))
    ids = np.flatnonzero(count)
    at, count, rows = (np.cumsum(count > 0, dtype=np.int32) - 1)[met], count[ids], state[ids]
    vectors, squares = np.stack([rows[:, :size], rows[:, size:2 * size]]), rows[:, 2 * size:].T.copy()
    often, rng = np.cumsum(count ** 0.75), np.random.default_rng(seed)
    for first in range(0, len(at), BLOCK):
        n = min(BLOCK, len(at) - first)
        here = at[first:first + n + window]
        noise = np.minimum(np.searchsorted(often, rng.random(SHARED) * often[-1], "right"), len(ids) - 1)
        slopes = _slopes(vectors.take(here, axis=1), vectors[1].take(noise, axis=0), text[first:first + n + window], n, window)
        both = np.concatenate([here, noise])
        order = np.argsort(both, kind="stable")
        begins = np.flatnonzero(np.diff(both[order], prepend=-1))
        which, times = both[order[begins]], np.diff(begins, append=len(both))
        again = np.flatnonzero(times > 1)
        several = order[np.repeat(times > 1, times)]
        ends = np.cumsum(times[again]) - times[again]
        for v, s, slope in zip(vectors, squares, slopes):
            g = slope.take(order[begins], axis=0)
            if len(again):
                g[again] = np.add.reduceat(slope.take(several, axis=0), ends, axis=0)
            s[which] += np.einsum("ij,ij->i", g, g) / size
            g *= (STEP / np.sqrt(s[which] + 1e-8))[:, None]
            v[which] += g
    return ids, count, np.concatenate([*vectors, squares.T], axis=1)


def _slopes(v: np.ndarray, noise: np.ndarray, text: np.ndarray, n: int, window: int) -> np.ndarray:
    """Slopes of the pairs that begin at the first n words, for v[0] and the neighbours v[1], the noise words last. A pair at
    distance d counts as often as windows of a length drawn from 1 to `window` hold it on average."""
    m = v.shape[1]
    out, pairs = np.zeros((2, m + len(noise), v.shape[2]), np.float32), np.zeros(m, np.float32)
    for d in range(1, min(window, m - 1) + 1):
        k = min(n, m - d)
        one, other = v[:, :k], v[::-1, d:d + k]
        weight = (text[:k] == text[d:d + k]) * np.float32((window + 1 - d) / window)
        pairs[:k] += weight
        pairs[d:d + k] += weight
        g = (weight * _unlike(np.einsum("aij,aij->ai", one, other)))[:, :, None]
        out[:, :k] += g * other
        out[::-1, d:d + k] += g * one
    g = _unlike(v[0] @ -noise.T)
    g *= (pairs * np.float32(-NOISE / len(noise)))[:, None]
    out[0, :m] += g @ noise
    out[1, m:] = g.T @ v[0]
    return out


def _unlike(x: np.ndarray) -> np.ndarray:
    """1 / (1 + e^x), in place."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All elements, and where each list begins among them, with their number at the end."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return lists.flatten(), np.concatenate([[0], np.cumsum(n)]).astype(np.int32)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.ravel()))
