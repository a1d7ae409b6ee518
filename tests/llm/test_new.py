"""Shared lines, fill-in-middle and centroid clusters against plain code, and their edge cases."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from offerloom.llm import centroids, lines, middle
from offerloom.llm.common import saved
from tests.llm.conftest import EDGE

LONG = "A line of words that is long enough to count as shared"


def lines_by_hand(rows, least_docs=5):
    """Sorted (id, kept text, lines, dropped) of (id, text) rows."""
    order = lambda i: (i is not None, i or 0)
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s.strip(" \t\n\x0b\x0c\r"))
    of = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                of.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        each = (text or "").split("\n")
        kept = [x for x in each if len(of.get(key(x), ())) < least_docs or i == max(of[key(x)], key=order)]
        out.append((i, "\n".join(kept), len(each), len(each) - len(kept)))
    return sorted(out, key=repr)


def cut_lines(df):
    bitmaps = saved(lines.keep_bitmaps(df), "bitmaps")
    return lines.apply_bitmaps(df, bitmaps)


def line_rows():
    rng = random.Random(4)
    some = [f"{LONG} number {k}, and so on and on" for k in range(12)] + ["short", "", "ÄÖÜ " * 11, LONG.upper(), f" \t{LONG}\r"]
    rows = [(i, "\n".join(rng.choices(some, k=rng.randint(1, 9)))) for i in range(60)]
    return [*rows, (3, rows[3][1]), (3, f"{LONG}\nother text of a known id"), (None, LONG), (None, f"{LONG}\nx"), (7, None), (8, "")]


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_lines_by_brute_force(spark, monkeypatch, block_rows):
    """Also with hashes so common that they are dealt to blocks."""
    monkeypatch.setattr(lines, "BLOCK_ROWS", block_rows)
    rows = line_rows()
    out = cut_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in out), key=repr) == lines_by_hand(rows)
    assert sum(r.n_dropped for r in out) > 100


def test_bitmaps(spark):
    text = "\n".join([LONG, LONG, "x", LONG, "y", "z"])
    rows = [(i, text) for i in range(6)]
    out = lines.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.n_dropped, list(r.changes)) for r in out) == [(i, 3, [0, 2, 3, 4]) for i in range(5)]


def test_lines_edge(edge, empty):
    names = ("doc_id", "text", "kept", "_text", "key", "n_words")
    clash = edge.select(*names, *(F.lit(n).alias(n) for n in ("id", "row", "r", "changes", "of_id", "of_row", "_cut", "n_lines")))
    out = cut_lines(clash)
    assert out.columns == [*(c for c in clash.columns if c != "n_lines"), "kept_text", "n_lines", "n_dropped"]
    got = out.collect()
    assert sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got), key=repr) == lines_by_hand(EDGE)
    assert {(r.kept, r._text, r.key, r.n_words, r.id, r._cut) for r in got} == {("x", 1, "y", 2, "id", "_cut")}
    assert cut_lines(empty).collect() == []


def test_string_ids(spark):
    rows = [(f"d{i}", f"{LONG}\nown {i}") for i in range(7)]
    out = {r.doc_id: r.kept_text for r in cut_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert out["d6"] == f"{LONG}\nown 6" and out["d2"] == "own 2"


def middle_by_hand(i, text):
    text = text or ""
    units = [x for x in text.splitlines(keepends=True)] if not set(text) & set("\r\x0b\x0c\x1c\x1d\x1e\x85  ") else regex.findall(r"[^\n]*\n|[^\n]+", text)
    s = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(s[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, x = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")):
        return i, n, "plain", None, None, text, text
    if h[3] % 100 < 50:
        return i, n, "spm", len(p), len(m), f"<S>{x}<P>{p}<M>{m}", text
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{x}<M>{m}", text


def test_middle_by_brute_force(spark, docs, edge, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000 + k, "".join(x)) for k, x in enumerate(itertools.product(["\n", "<", "P>", "<M", "é"], repeat=4))] + [(None, "a\nb\n\nc"), (5, "x\n" * 200_000)]
    for df, want in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (edge, EDGE), (empty, [])):
        out = middle.fill_in_middle(df).withColumn("restored", middle.restored(F.col("output"), F.col("form")))
        got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in out.collect()]
        assert sorted(got, key=repr) == sorted((middle_by_hand(*r) for r in want), key=repr)


def test_middle_options(spark):
    df = spark.createDataFrame([(i, "one two three") for i in range(400)], "doc_id long, text string")
    words = middle.fill_in_middle(df, percent=30, percent_spm=0, unit=r"\S+\s*")
    forms = {r.form: r["count"] for r in words.groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160 and words.filter("n <> 3").count() == 0
    assert middle.fill_in_middle(df.limit(1), unit="[a-z]").first().n is None  # spaces are in no unit


def clusters_by_hand(vectors, k, rounds, seed=3, scale=1024):
    """{row: (cluster, distance)} and the centroids, in Python's whole numbers."""
    import math

    held = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors]
    first = sorted(held, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    cs = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda v: min((far(v, c), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in held:
            groups.setdefault(pick(v)[1], []).append(v)
        cs = [[sum(x) // len(g) for x in zip(*g)] if (g := groups.get(n)) else c for n, c in enumerate(cs)]
    return sorted((i, pick(v)[1], pick(v)[0]) for i, v in held), cs


@pytest.mark.parametrize("spread", [1.0, 1e9])  # beyond 64-bit arithmetic as well
def test_clusters_by_brute_force(spark, spread):
    rng = random.Random(5)
    rows = [(i, [float(rng.choice([-1, 0, 0.3, rng.gauss(0, 1)])) * (spread if i % 3 else 1) for _ in range(5)]) for i in range(300)]
    rows += [(300, rows[0][1]), (0, rows[0][1])]
    bad = [(400, None), (401, [1.0]), (402, [1.0, None, 0.0, 0.0, 0.0]), (403, [float("nan")] * 5), (404, [float("inf")] * 5), (405, [0.0] * 6)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(3)
    out, held = centroids.cluster(df, k=6, rounds=4, dims=5)
    want, cs = clusters_by_hand(rows, 6, 4)
    most = 2**63 - 1
    assert held == cs
    assert sorted((r.vec_id, r.cluster, r.distance) for r in out.collect()) == [(i, c, min(d, most)) for i, c, d in want]
    full = centroids.with_inertia(out, held).collect()
    assert {r.inertia for r in full} == {min(most, sum(min(d, most) for *_, d in want))}
    assert {(r.cluster, r.centroid_sha256) for r in full} == {(c, hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()) for _, c, _ in want}


def test_walk_ends_early():
    """With few dimensions and many centroids most distances aren't computed, and ties go to the smaller number."""
    rng = np.random.default_rng(6)
    x, c = rng.integers(-1000, 1000, (500, 3)), rng.integers(-1000, 1000, (64, 3))
    c[40] = c[9]
    number, distance, computed = centroids.nearest(x, c)
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and (number != 40).all()
    assert computed < 0.5 * every.size


def test_few_vectors(spark):
    rows = [(1, [0.5] * 4), (2, [float("1e300")] * 4), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, held = centroids.cluster(df, k=8, rounds=2, dims=4)
    assert len(held) == 3 and {r.distance for r in out.collect()} == {0}
    none, held = centroids.cluster(df.limit(0), dims=4)
    assert held == [] and centroids.with_inertia(none, held).collect() == []
    extra = df.selectExpr("vec_id", "embedding", "1 AS id", "2 AS cluster", "3 AS narrow")
    assert centroids.cluster(extra, k=1, rounds=1, dims=4)[0].columns == ["vec_id", "cluster", "distance"]
