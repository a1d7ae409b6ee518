"""Merge histories by jumps, against following each of them."""

import random

from offerloom.operators import merges


def by_hand(pairs, edges):
    up = {}
    for c, p in edges:
        if c is not None and p is not None and c != p:
            up[c] = min(p, up.get(c, p))
    out = set()
    for c, a in set(pairs):
        at, seen = up.get(c), set()
        while at is not None and at not in seen and at != c:
            if at == a:
                out.add((c, a))
            seen.add(at)
            at = up.get(at)
    return sorted(out)


def test_forest_with_cycles(spark):
    rng = random.Random(3)
    edges = [(k, rng.randint(max(0, k - 9), k - 1)) for k in range(1, 300) if rng.random() < 0.9]
    edges += [(5, 5), (None, 3), (3, None), (7, 1)] + edges[:4] + [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1001), (1004, 1003)]
    nodes = [*range(300), *range(998, 1006)]
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(3000)] + [(1004, 1000), (1000, 1002), (1000, 1000), (1003, 1004), (None, 1), (1, None)]
    got = merges.merged_into(spark.createDataFrame(pairs, "product_id long, ancestor long"), spark.createDataFrame(edges, "child long, parent long"))
    want = by_hand([p for p in pairs if None not in p], edges)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50 and (1004, 1000) in want


def test_long_chain(spark):
    """A hundred thousand merges one after another: as many rows for each level, none for pairs that nobody asks for."""
    n = 100_000
    edges = spark.range(n).selectExpr("id AS child", "id + 1 AS parent")
    asked = [(0, n), (0, n - 1), (1, 0), (17, 99_998), (99_999, n), (n, 99_999), (50_000, 50_001), (3, n + 1)]
    table = merges.jumps(edges)
    got = merges.merged_into(spark.createDataFrame(asked, "product_id long, ancestor long"), edges, table)
    assert sorted(map(tuple, got.collect())) == sorted((a, b) for a, b in asked if a < b <= n)
    assert len(table.levels) == 17 and table.levels[16].count() == n + 1 - (1 << 16) and table.endless.isEmpty()


def test_empty(spark):
    edges, pairs = spark.createDataFrame([(1, 2)], "child long, parent long"), spark.createDataFrame([(1, 2)], "product_id long, ancestor long")
    assert merges.merged_into(pairs.limit(0), edges).count() == merges.merged_into(pairs, edges.limit(0)).count() == 0
