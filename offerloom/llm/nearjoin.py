"""Joining texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. Each text becomes a set of 64-bit shingle hashes, a key of that set and a MinHash signature. Texts with equal sets are
   copies: they share a key, and from here on each key stands once.
2. Keys that agree on one band of their signatures meet. Each bucket gives links to its smallest key only, so a bucket of
   any size gives as many rows as it has members; connected components of these links are the candidate groups.
3. Pairs are compared inside a candidate group; in one of more than 65,536 members whose buckets hold fewer pairs than the
   group (long chains of neighbours), inside its buckets instead, each pair in the first bucket that it shares. Groups and
   buckets are split into blocks of bounded size, and a task compares two blocks. A pair's MinHash values are compared a few at a
   time and the pair is dropped when the posterior probability that its similarity reaches the threshold falls below a
   tolerance; what is left is verified exactly on the shingle sets.
4. Tasks give counts of links and links to local roots, again one row per member. Their components are the classes.

Texts of candidates only are moved: a filter of bounded size keeps the others from the shuffle.

With 32 bands of 5 values, a pair at exactly 0.8 never meets with a probability of 3e-6, less above.

Words are runs without white space. A text of one to four words has one shingle, all its words. A text without words (or
null) has no shingle, no link, and is a class of its own. Repeated rows and copies are all returned; a null id gets a
class like any other, whose id is the smallest id that is not null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.common import free, parted, saved

WORDS = 5
BANDS, BAND_VALUES = 32, 5
VALUES = BANDS * BAND_VALUES
#: MinHash values compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: A group is split into blocks of a 16th of it, but of no fewer and no more members than these. A task has two blocks, so a
#: member of a group stands in up to 16 tasks, and beyond 65,536 members in as many as there are blocks.
LEAST_BLOCK, MOST_BLOCK, PARTS = 128, 4096, 16
#: Members that are compared with each other at once inside a task.
AT_ONCE = 1024

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, VALUES, dtype=np.uint64)
_POWERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    if len(words) < WORDS:
        return np.array([digest(" ".join(words))], np.uint64)
    n = len(words) - WORDS + 1
    out = h[:n] * _POWERS[0]
    for k in range(1, WORDS):
        out ^= out >> np.uint64(29)
        out += h[k : k + n]
        out *= _POWERS[k]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values; the high halves of multiply-add hashes."""
    least = np.full(VALUES, 2**32 - 1, np.uint32)
    for i in range(0, len(s), 2048):
        x = s[i : i + 2048, None] * _MULTIPLY + _ADD
        least = np.minimum(least, (x >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return least


def set_key(s: np.ndarray) -> str:
    return hashlib.md5(s.tobytes()).hexdigest() if len(s) else ""


@lru_cache
def matches_needed(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For n = 0..VALUES values compared, the fewest matches at which the posterior probability of reaching the threshold
    is not below the tolerance. The prior is uniform, so the posterior is a Beta distribution whose tail is a binomial sum."""
    out = []
    for n in range(VALUES + 1):
        tail, m = 0.0, -1
        while tail < tolerance and m < n:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def likely_pairs(a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of a and j of b (i < j if they are the same block) that pass every comparison."""
    needed = matches_needed(threshold)
    count = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        count += a[:, k, None] == b[None, :, k]
    keep = count >= needed[STEP]
    i, j = np.nonzero(np.triu(keep, 1) if same else keep)
    found = count[i, j].astype(np.int32)
    for n in range(STEP, VALUES, STEP):
        if not len(i):
            break
        found += (a[i, n : n + STEP] == b[j, n : n + STEP]).sum(axis=1, dtype=np.int32)
        keep = found >= needed[n + STEP]
        i, j, found = i[keep], j[keep], found[keep]
    return i, j


def overlaps(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a[i] and b[j]; for many pairs by products of 0/1 matrices over the shared shingles."""
    if len(i) <= 4 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    values = [np.concatenate(x) for x in (a, b)]
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    if a is b:
        once, n = np.unique(values[0], return_counts=True)
        shared = once[n > 1]
    else:
        shared = np.intersect1d(*values)
    columns = []
    for v, r in zip(values, rows):
        at = np.searchsorted(shared, v)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == v[hit]
        columns.append((r[hit], at[hit]))
    total = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, len(shared), 2048):
        parts = []
        for (r, c), x in zip(columns, (a, b)):
            m = np.zeros((len(x), 2048), np.float32)
            inside = (c >= start) & (c < start + 2048)
            m[r[inside], c[inside] - start] = 1
            parts.append(m)
        total += parts[0] @ parts[1].T
    return total[i, j].astype(np.int64)


def agree_on(k: int, sig_a: np.ndarray, sig_b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) have equal values in band k."""
    at = slice(k * BAND_VALUES, (k + 1) * BAND_VALUES)
    return (sig_a[i, at] == sig_b[j, at]).all(axis=1)


def linked(a: list[np.ndarray], b: list[np.ndarray], sig_a: np.ndarray, sig_b: np.ndarray, same: bool, threshold: float, band: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that agree on a band and whose exact similarity is the threshold or more; in a bucket of a band, those that agree
    on no band before. So a pair is linked by one rule, wherever it is compared."""
    i, j = likely_pairs(sig_a, sig_b, same, threshold)
    if band < 0:
        apart = np.arange(len(i))
        for k in range(BANDS):
            apart = apart[~agree_on(k, sig_a, sig_b, i[apart], j[apart])]
        i, j = np.delete(i, apart), np.delete(j, apart)
    for k in range(band):
        fresh = ~agree_on(k, sig_a, sig_b, i, j)
        i, j = i[fresh], j[fresh]
    if not len(i):
        return i, j
    both = overlaps(a, a if same else b, i, j)
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    keep = both >= threshold * (size_a[i] + size_b[j] - both) - 1e-9
    return i[keep], j[keep]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for the nodes of edges (a, b); equal roots for connected nodes.

    Each round every node takes the smallest of itself and its neighbours as its label and the graph is contracted to the
    labels, so that a node with very many neighbours, or many nodes around a few, shrink at once. Nodes are hashes, so
    the rounds are few. Each round's labels and edges are tables in the shared folder; they are put together at the end.
    """
    edges = saved(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    rounds = []
    while not rounds or edges.limit(1).count():
        near = edges.union(edges.select("b", "a")).toDF("node", "near")
        labels = saved(near.groupBy("node").agg(F.min("near").alias("root")).select("node", F.least("node", "root").alias("root")), f"{name}-labels")
        rounds.append(labels)
        la, lb = labels.select(F.col("node").alias("a"), F.col("root").alias("la")), labels.select(F.col("node").alias("b"), F.col("root").alias("lb"))
        moved = edges.join(la, "a").join(lb, "b").filter("la <> lb")
        edges = saved(moved.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), f"{name}-edges")
    out = rounds[0]
    for labels in rounds[1:]:
        out = out.join(labels.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out


def join_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per row of docs: id, class_id (smallest id of its class), n_links (other texts linked with it, copies
    counted once), n_copies (rows with its set of shingles, itself included) and set_key (equal for copies)."""
    return _classes(docs, id_col, text_col, threshold).drop("root")


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """join_near with `root`, equal for the keys of a class."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                sets = [shingles(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(set_key, sets), pa.string()), pa.array([signature(s).tobytes() for s in sets], pa.binary())], ["id", "key", "signature"])

    sketches = saved(rows.mapInArrow(sketch, f"id {id_type}, key string, signature binary"), "sketches")
    keys = saved(
        sketches.filter("key != ''").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n_copies"), F.first("signature").alias("signature")),
        "keys",
    )

    # buckets of equal bands, each linked to its smallest key
    width = 4 * BAND_VALUES
    # a handle stands for a key here, as rows are many: two keys with one handle only make a candidate group larger
    handle = F.xxhash64("key")

    def buckets(of: DataFrame) -> DataFrame:
        values = F.array(*(F.xxhash64(F.col("signature").substr(k * width + 1, width)) for k in range(BANDS)))
        return of.select("handle", F.posexplode(values).alias("band", "hash")).select("handle", "band", F.xxhash64("band", "hash").alias("bucket"))

    member = buckets(keys.select(handle.alias("handle"), "signature"))
    hubs = member.groupBy("bucket", "band").agg(F.min("handle").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("bucket", "hub")
    edges = member.select("handle", "bucket").join(hubs, "bucket").filter("handle != hub").select(F.col("hub").alias("a"), F.col("handle").alias("b")).distinct()
    groups = saved(components(edges, "candidates").withColumnRenamed("node", "handle"), "groups")

    # where a candidate is compared: in its group, or in its buckets
    def block_size(n: Column) -> Column:
        return F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(MOST_BLOCK), F.ceil(n / PARTS)))

    def place(group: str, band: Column) -> Column:
        blocks = F.ceil(F.col("n") / block_size(F.col("n"))).cast("int")
        return F.struct(F.col(group).alias("group"), band.cast("int").alias("band"), blocks.alias("blocks"), F.pmod(F.xxhash64(F.lit(7), "handle"), blocks).cast("int").alias("block"))

    sizes = saved(groups.groupBy("root", F.xxhash64("root").alias("_")).agg(F.count("*").alias("n")).drop("_"), "sizes")
    large = groups.join(sizes.filter(F.col("n") > PARTS * MOST_BLOCK), "root")
    _, likely = parted(keys.select(handle.alias("handle"), "signature"), F.col("handle"), saved(large.select("handle"), "large"))
    held = buckets(likely).join(large, "handle")
    held_sizes = held.groupBy("root", "n", "bucket").agg(F.count("*").alias("m")).filter("m > 1")
    dense = held_sizes.groupBy("root", "n").agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("pairs"))
    sparse = saved(dense.filter(F.col("pairs") < F.col("n").cast("double") * F.col("n")).select("root"), "sparse")
    in_group = groups.join(sizes, "root").join(sparse, "root", "left_anti").select("handle", place("root", F.lit(-1)).alias("place"))
    in_bucket = held.drop("n").join(sparse, "root", "left_semi").join(held_sizes.select("root", "bucket", F.col("m").alias("n")), ["root", "bucket"]).select("handle", place("bucket", F.col("band")).alias("place"))
    places = in_group.union(in_bucket).groupBy("handle").agg(F.collect_list("place").alias("places"))  # one, or one for each band
    wanted = saved(places.join(keys.select(handle.alias("handle"), "key", F.col("id").alias("rep")), "handle").select("key", "rep", "places"), "wanted")

    known = wanted.filter("rep is not null").withColumnRenamed("rep", "id")
    _, likely_rows = parted(rows.filter("id is not null"), F.xxhash64("id"), known.select(F.xxhash64("id").alias("hash")))
    texts = likely_rows.join(known, "id").select("text", "key", "places")
    # keys that no row with an id has: found by their text's own key
    nameless = rows.filter("id is null").select("text")

    def with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                sets = [shingles(t) for t in part.column(0).to_pylist()]
                keep = [k for k, (s, key) in enumerate(zip(sets, part.column(1).to_pylist())) if set_key(s) == key]  # another row may have the same id
                rest = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rest.column(1), rest.column(2), pa.array([sets[k].tobytes() for k in keep], pa.binary()), pa.array([signature(sets[k]).tobytes() for k in keep], pa.binary())],
                    ["key", "places", "shingles", "signature"],
                )

    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            yield pa.RecordBatch.from_arrays([texts, pa.array([set_key(shingles(t)) for t in texts.to_pylist()], pa.string())], ["text", "key"])

    nameless = nameless.mapInArrow(with_key, "text string, key string").join(wanted.filter("rep is null"), "key").select("text", "key", "places")
    members = texts.union(nameless).mapInArrow(with_shingles, f"key string, places {wanted.schema['places'].dataType.simpleString()}, shingles binary, signature binary")
    members = members.select("key", "shingles", "signature", F.inline("places"))
    tasks = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select("key", "shingles", "signature", "block", "group", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(task: pa.Table) -> pa.Table:
        low, high, band = (task.column(c)[0].as_py() for c in ("low", "high", "band"))
        sides: list[dict[str, tuple[bytes, bytes]]] = [{}, {}]
        for key, block, values, hashes in zip(*(task.column(c).to_pylist() for c in ("key", "block", "shingles", "signature"))):
            sides[block != low][key] = values, hashes  # repeated rows count once
        same = low == high
        names = [sorted(side) for side in (sides[:1] if same else sides)]
        sets = [[np.frombuffer(side[k][0], np.uint64) for k in keys] for side, keys in zip(sides, names)]
        signatures = [np.frombuffer(b"".join(side[k][1] for k in keys), np.uint32).reshape(-1, VALUES) for side, keys in zip(sides, names)]
        everyone, shift = (names[0], 0) if same else (names[0] + names[1], len(names[0]))
        count, firsts, seconds = np.zeros(len(everyone), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x in range(0, len(sets[0]), AT_ONCE):
            for y in range(x if same else 0, len(sets[-1]), AT_ONCE):
                parts = sets[0][x : x + AT_ONCE], sets[-1][y : y + AT_ONCE]
                one = same and x == y
                i, j = linked(parts[0], parts[0] if one else parts[1], signatures[0][x : x + AT_ONCE], signatures[-1][y : y + AT_ONCE], one, threshold, band)
                i, j = i + x, j + y + shift
                count += np.bincount(i, minlength=len(everyone)) + np.bincount(j, minlength=len(everyone))
                # of a part's pairs only links to its roots stay
                ends, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                root = local_roots(len(ends), at[: len(i)], at[len(i) :])
                firsts.append(ends)
                seconds.append(ends[root])
        root = local_roots(len(everyone), np.concatenate(firsts), np.concatenate(seconds))
        has = np.nonzero(count)[0]
        return pa.table({"key": pa.array([everyone[k] for k in has], pa.string()), "local": pa.array([everyone[root[k]] for k in has], pa.string()), "links": pa.array(count[has], pa.int64())})

    found = saved(tasks.groupBy("group", "band", "low", "high").applyInArrow(compare, "key string, local string, links long"), "links")
    classes = components(found.select(F.col("local").alias("a"), F.col("key").alias("b")).distinct(), "classes")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    of_key = keys.select("key", "id", "n_copies").join(classes.withColumnRenamed("node", "key"), "key", "left").join(links, "key", "left")
    of_key = saved(of_key.select("key", "n_copies", "id", F.coalesce("root", "key").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "of-key")
    class_ids = of_key.groupBy("root", F.length("root").alias("_")).agg(F.min("id").alias("class_id")).select("root", "class_id")
    of_key = saved(of_key.join(class_ids, "root").select("key", "class_id", "root", "n_links", "n_copies"), "classes")
    out = sketches.select("id", "key").join(of_key, "key", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("key") == "", F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key") == "", F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        F.col("key").alias("set_key"),
        "root",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row of docs for each class of copies and linked texts (chains of links included), that with the smallest id;
    repeated rows of an id stay once, and its other texts are judged by themselves. Rows with a null id stay only where no row
    of their class has an id."""
    key_, only_ = (free(n, docs.columns) for n in ("_set_key", "_only"))
    joined = saved(_classes(docs, id_col, text_col, threshold).select(id_col, "class_id", "set_key", "root"), "joined")
    ids = joined.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.count("*").alias("_n"), F.bool_or(F.col(id_col) != F.col("class_id")).alias("_gone"), F.min("set_key").alias("_low"), F.max("set_key").alias("_high"), F.count_if(F.col("set_key") == "").alias("_empty")
    )
    # most ids stand once and lead their class; their rows aren't moved
    touched = saved(ids.filter("_n > 1 or _gone").select(id_col, "_gone", ((F.col("_low") != F.col("_high")) | (F.col("_empty") > 1)).alias("_torn")), "touched")
    alone, likely = parted(docs.filter(F.col(id_col).isNotNull()), F.xxhash64(id_col), touched.select(F.xxhash64(id_col).alias("_hash")))
    untouched = likely.join(touched, id_col, "left_anti")
    repeated = likely.join(touched.filter("not _gone and not _torn"), id_col, "left_semi").dropDuplicates([id_col])
    named = alone.unionByName(untouched).unionByName(repeated)
    torn = touched.filter("_torn").select(id_col)
    nameless = docs.filter(F.col(id_col).isNull()).dropDuplicates([text_col])
    lonely = joined.filter(F.col(id_col).isNull() & F.col("class_id").isNull()).select("set_key").distinct()

    at = docs.columns.index(text_col)

    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(key_, pa.array([set_key(shingles(t)) for t in batch.column(at).to_pylist()], pa.string()))

    schema = T.StructType([*docs.schema.fields, T.StructField(key_, T.StringType())])
    nameless = nameless.mapInArrow(with_key, schema).join(lonely.withColumnRenamed("set_key", key_), key_, "left_semi")
    out = named.select(docs.columns).unionByName(nameless.select(docs.columns))
    if torn.isEmpty():
        return out

    # texts of such an id: one key of each class that the id stands for, and every text without shingles
    first = joined.join(torn, id_col, "left_semi").filter(F.col(id_col) == F.col("class_id"))
    lead = first.filter("set_key <> ''").groupBy(id_col, "root").agg(F.min("set_key").alias(key_)).select(id_col, key_)
    kept = lead.union(first.filter("set_key = ''").select(id_col, "set_key").distinct())
    texts = likely.join(torn, id_col, "left_semi").select(docs.columns).mapInArrow(with_key, schema).join(kept, [id_col, key_], "left_semi")
    texts = texts.withColumn(only_, F.when(F.col(key_) == "", F.col(text_col))).dropDuplicates([id_col, key_, only_])
    return out.unionByName(texts.select(docs.columns))
