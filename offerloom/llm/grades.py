"""Quality grades by ordinal cumulative-link regression on hashed text.

A text's grade is 0 (toxic), 1 (low quality) or 2 (good and clean); any ordered grades work. One weight vector
over hashed features gives a score s, and ordered thresholds t_k give P(grade <= k) = sigmoid(t_k - s). Expected grade and
the probability of the top grade follow from them.

Features are hashed to a fixed number of slots: each distinct word (without the signs around it, in lower case), and how
large a share of a text's words has an odd shape: capitals, a tail of signs, digits; besides, how many words and
lines repeat. Training takes a bounded sample of labelled texts (documented parameter); scoring covers whole texts.

Null text is the empty text; it has no feature but "empty". Texts of any length are scored whole; repeated rows and null
ids are scored like others. Without labels every text gets the same grade probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.common import Memo
from offerloom.llm.rules import training_rows

SLOTS = 1 << 18
#: At most so many labelled texts are learned from, taken in order of a hash of the id.
TRAINING_ROWS = 6_000
GRADES = 3
_TAIL = re.compile(r"[^\w\s]{1,3}$")
_EDGE = re.compile(r"^\W+|[\W_]+$")
#: Weight of a share against a word's presence, so that both learn at one pace.
_SHARE_SCALE = 8.0


def slot(name: str) -> int:
    return xxhash.xxh64_intdigest(name) % SLOTS


def word_slots(word: str) -> tuple[int, int]:
    """The slot of the bare word, -1 for none, and the slot of its shape, -1 for a plain word."""
    bare = _EDGE.sub("", word).lower()
    tail = _TAIL.search(word)
    shape = ""
    if len(bare) > 1 and word.isupper():
        shape = "capitals"
    elif tail and len(tail[0]) > 1:
        shape = "tail of signs"
    elif not bare:
        shape = "only signs"
    elif any(c.isdigit() for c in word):
        shape = "digits"
    return slot(f"word {bare}") if bare else -1, slot(f"shape {shape}") if shape else -1


def whole_text(words: list[str], distinct: int, text: str) -> list[int]:
    """Slots of what holds for the text as a whole."""
    if not words:
        return [slot("empty")]
    lines = [line for line in text.split("\n") if line]
    repeated_lines = 1 - len(set(lines)) / len(lines)
    fresh = distinct / len(words) ** 0.75  # distinct words grow a little slower than words
    return [slot(f"lines {int(10 * repeated_lines)}"), slot(f"fresh {min(20, int(5 * fresh))}"), slot(f"seldom fresh {fresh < 1.2}"), slot(f"length {min(len(words), 1 << 14).bit_length()}")]


def features(text: str | None, memo: Memo) -> dict[int, float]:
    words = (text or "").split()
    distinct = set(words)
    out: Counter = Counter()
    for word in distinct:
        if memo[word][0] >= 0:
            out[memo[word][0]] += 1.0
    for word in words:
        if memo[word][1] >= 0:
            out[memo[word][1]] += _SHARE_SCALE / len(words)
    for s in whole_text(words, len(distinct), text or ""):
        out[s] += 1.0
    return out


@dataclass
class OrdinalModel:
    weights: dict[int, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.array([-1.0, 0.0]))

    def word_weight(self, word: str) -> complex:
        """Real part: weight of the word itself; imaginary part: weight of its shape, to be divided by the number of words."""
        bare, shape = word_slots(word)
        return complex(self.weights.get(bare, 0.0), self.weights.get(shape, 0.0))

    def score(self, text: str | None, memo: Memo) -> float:
        words = (text or "").split()
        distinct = set(words)
        bare, shapes = sum(map(memo.__getitem__, distinct), 0j).real, sum(map(memo.__getitem__, words), 0j).imag
        rest = sum(self.weights.get(s, 0.0) for s in whole_text(words, len(distinct), text or ""))
        return bare + _SHARE_SCALE * shapes / max(1, len(words)) + rest

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0..; one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = GRADES, rounds: int = 400, rate: float = 0.05, shrink: float = 1e-3, least_z: float = 5.0) -> OrdinalModel:
    """Maximum likelihood by Adam over slots, values and grade of each text. Only slots go in whose amount tells texts above and
    below some grade apart, by `least_z` standard errors or more: most words say nothing, and there are very many."""
    if not rows:
        return OrdinalModel(thresholds=np.linspace(-1, 0, grades - 1))
    y = np.array([r[2] for r in rows])
    column, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, at = np.unique(column, return_inverse=True)
    size, told = np.sqrt(np.bincount(at, weights=value * value)), np.zeros(len(used))
    for k in range(grades - 1):
        below = (y <= k) - (y <= k).mean()
        if below.std() > 0:
            told = np.maximum(told, np.abs(np.bincount(at, weights=value * below[row])) / (size * below.std()))
    chosen = told >= least_z
    keep = chosen[at]
    place = np.cumsum(chosen) - 1
    used, at, row, value = used[chosen], place[at[keep]], row[keep], value[keep]
    w, n = np.zeros(len(used)), len(rows)
    share = np.array([(y <= k).mean() for k in range(grades - 1)]).clip(0.01, 0.99)
    first = np.log(share / (1 - share))
    # thresholds as a start and positive steps keeps them in order
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    moment, spread = np.zeros(len(w) + len(free)), np.zeros(len(w) + len(free))
    sig = lambda x: 1 / (1 + np.exp(np.clip(-x, -40, 40)))
    for step in range(1, rounds + 1):
        t = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        s = np.bincount(row, weights=w[at] * value, minlength=n)
        padded = np.concatenate([[-np.inf], t, [np.inf]])
        high, low = sig(padded[y + 1] - s), sig(padded[y] - s)
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_s = (d_high - d_low) / n  # of the negative log likelihood
        d_t = np.zeros(grades + 1)
        np.add.at(d_t, y + 1, -d_high / n)
        np.add.at(d_t, y, d_low / n)
        d_t = d_t[1:-1]
        d_free = np.concatenate([[d_t.sum()], [d_t[k:].sum() * np.exp(free[k]) for k in range(1, len(free))]])
        d_w = np.bincount(at, weights=d_s[row] * value, minlength=len(w)) + shrink * w
        d = np.concatenate([d_w, d_free])
        moment = 0.9 * moment + 0.1 * d
        spread = 0.999 * spread + 0.001 * d * d
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        w -= move[: len(w)]
        free -= move[len(w) :]
    t = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return OrdinalModel({int(k): float(v) for k, v in zip(used, w) if abs(v) > 1e-6}, t)


def grade(quality: Column, toxic: Column) -> Column:
    return F.when(toxic > 0, 0).when(quality < 1, 1).otherwise(2)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """From at most `rows` labelled texts. A text's hashed features come to the driver, not the text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_slots)
        for batch in batches:
            memo.trim()
            found = [features(t, memo) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.float64()))], ["id", "grade", "slots", "amounts"])

    sample = training_rows(docs, labels, rows, id_col, text_col).select(F.col(id_col).cast("string").alias("id"), grade(F.col("quality"), F.col("toxic")).cast("int").alias("grade"), F.col(text_col).alias("text"))
    got = sample.mapInArrow(hashed, "id string, grade int, slots array<int>, amounts array<double>").toArrow().sort_by([("id", "ascending"), ("grade", "ascending")])
    slots, amounts = got.column("slots").combine_chunks(), got.column("amounts").combine_chunks()
    return fit([(np.asarray(s.values), np.asarray(a.values), g) for s, a, g in zip(slots, amounts, got.column("grade").to_pylist())])


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """docs with expected_grade, tail_probability (of the top grade) and selected (tail_probability of 0.5 or more).
    Columns of these names are replaced."""
    added = ["expected_grade", "tail_probability"]
    kept = docs.drop(*added, "selected")
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(model.word_weight)
        for batch in batches:
            memo.trim()
            tails = model.tails(np.array([model.score(t, memo) for t in batch.column(at).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], [*batch.schema.names, *added])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, T.DoubleType()) for name in added)])
    return kept.mapInArrow(run, schema).withColumn("selected", F.col("tail_probability") >= 0.5)
