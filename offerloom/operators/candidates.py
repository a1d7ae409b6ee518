"""Candidate products for offers: nearest neighbours, token relevance, merging of sources, categories."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.operators.quantiles import quantiles


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, x: s + x)


#: Queries and vectors that meet in one task, and queries whose distances are computed at once inside it.
QUERY_ROWS, VECTOR_ROWS, AT_ONCE = 512, 4096, 16


def nearest(queries: DataFrame, vectors: DataFrame, k: int, max_distance: float | None = None, block: str | None = None) -> DataFrame:
    """Exact k nearest vectors under squared distance: (query_id, vector_id, distance, place). Ties by vector id.

    Queries (query_id, embedding) are a stated set; every vector (vector_id, embedding) is held against them. Both are dealt
    by a hash to blocks of bounded size, of which there are as many as their rows ask for; two blocks meet in a task, which
    keeps the best k for each of its queries before they meet. With `block`, only pairs that agree in that column are
    compared. Rows without an embedding have no distance and are left out."""
    on = [block] if block else []
    q = queries.filter("embedding is not null").select("query_id", F.col("embedding").alias("_q"), *on)
    v = vectors.filter("embedding is not null").select("vector_id", F.col("embedding").alias("_v"), *on)
    n_q, n_v = (max(1, -(-df.count() // rows)) for df, rows in ((q, QUERY_ROWS), (v, VECTOR_ROWS)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("_qs", F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int")).withColumn("_vs", every(n_v))
    v = v.withColumn("_vs", F.pmod(F.xxhash64("vector_id"), F.lit(n_v)).cast("int")).withColumn("_qs", every(n_q))
    kinds = (queries.schema["query_id"].dataType.simpleString(), vectors.schema["vector_id"].dataType.simpleString())

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("vector_id").to_numpy()
        a, b = (np.array(t.column(c).to_pylist(), float).reshape(t.num_rows, -1) for t, c in ((left, "_q"), (right, "_v")))
        at_q, at_v, far = [], [], []
        for start in range(0, len(a) if len(b) else 0, AT_ONCE):
            distance = ((a[start : start + AT_ONCE, None, :] - b[None, :, :]) ** 2).sum(axis=2)
            for row, d in enumerate(distance):
                best = np.lexsort((ids, d))[:k]
                at_q += [start + row] * len(best)
                at_v.append(best)
                far.append(d[best])
        at_v = np.concatenate(at_v) if at_v else np.zeros(0, int)
        distances = pa.array(np.concatenate(far) if far else np.zeros(0))
        return pa.table({"query_id": left.column("query_id").take(pa.array(at_q, pa.int64())), "vector_id": right.column("vector_id").take(pa.array(at_v)), "distance": distances})

    keys = ["_qs", "_vs", *on]
    pairs = q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInArrow(compare, f"query_id {kinds[0]}, vector_id {kinds[1]}, distance double")
    if max_distance is not None:
        pairs = pairs.filter(F.col("distance") <= max_distance)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vector_id"))
    return pairs.withColumn("place", place).filter(F.col("place") <= k).select("query_id", "vector_id", "distance", "place")


#: Queries and their words that meet in one task with so many words of texts, and cells of a matrix of texts by words.
QUERY_WORDS, TEXT_WORDS, CELLS = 16_384, 1_000_000, 1 << 21


def relevant(queries: DataFrame, texts: DataFrame, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25: (query_id, text_id, relevance, place) of the k most relevant texts for each query, to nine places, ties by text id.

    Takes (query_id, words) and (text_id, words). Queries are a stated set, and every text is held against them. Both are
    dealt by a hash to blocks of bounded size; two blocks meet in a task, which keeps the best k for each of its queries, so
    a word that all texts have costs no more rows than a rare one. A text without words (or null) is relevant to nothing and
    counts as a text; rows of a repeated query id are one query, rows of a repeated text id are texts of their own."""
    none = F.array().cast("array<string>")
    wanted = queries.select("query_id", F.explode("words").alias("word")).filter("word is not null").distinct()
    sized = texts.select("text_id", F.coalesce("words", none).alias("words")).withColumn("length", F.size("words"))
    facts = sized.agg(F.count("*").alias("n"), F.sum("length").alias("words")).first()  # two numbers
    asked = wanted.agg(F.countDistinct("query_id").alias("n"), F.count("*").alias("words")).first()  # two numbers
    n_q = max(1, -(-asked["n"] // QUERY_ROWS), -(-asked["words"] // QUERY_WORDS))
    n_t = max(1, -(-(facts["words"] or 0) // TEXT_WORDS))
    mean = (facts["words"] or 0) / facts["n"] if facts["words"] else 1.0
    df = sized.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(float(facts["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    q = wanted.join(df, "word").select("query_id", "word", idf.alias("idf"), F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("_qs"), F.explode(F.sequence(F.lit(0), F.lit(n_t - 1))).alias("_ts"))
    # texts are dealt by their words as well, so that rows of one id don't gather
    t = sized.filter("length > 0").withColumn("_ts", F.pmod(F.xxhash64("text_id", "words"), F.lit(n_t)).cast("int")).withColumn("_qs", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    kinds = (queries.schema["query_id"].dataType.simpleString(), texts.schema["text_id"].dataType.simpleString())

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names, vocabulary = (left.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("query_id", "word"))
        n, width = len(names.dictionary), len(vocabulary.dictionary)
        asked = np.zeros((n, width))
        asked[names.indices.to_numpy(), vocabulary.indices.to_numpy()] = left.column("idf").to_numpy()
        right = right.take(pc.sort_indices(right, sort_keys=[("text_id", "ascending")], null_placement="at_start"))
        best, at = np.zeros((n, 0)), np.zeros((n, 0), int)
        step = max(1, CELLS // max(1, width))
        for start in range(0, right.num_rows if n else 0, step):
            part = right.slice(start, step)
            words, length = part.column("words").combine_chunks(), part.column("length").to_numpy()
            found = pc.index_in(words.flatten(), value_set=vocabulary.dictionary)
            known = found.is_valid().to_numpy(zero_copy_only=False)
            cells, tf = np.unique(words.value_parent_indices().to_numpy()[known].astype(np.int64) * width + found.drop_null().to_numpy(), return_counts=True)
            row = cells // width
            counts = np.zeros((len(length), width))
            counts.flat[cells] = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[row] / mean))
            scores = np.round(asked @ counts.T, 9)
            # earlier texts stand first, so a stable order gives ties to the smaller id
            scores, places = np.hstack([best, scores]), np.hstack([at, np.broadcast_to(np.arange(start, start + len(length)), (n, len(length)))])
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            best, at = np.take_along_axis(scores, order, 1), np.take_along_axis(places, order, 1)
        who, which = np.nonzero(best > 0)
        return pa.table({"query_id": names.dictionary.take(pa.array(who)), "text_id": right.column("text_id").take(pa.array(at[who, which])), "relevance": pa.array(best[who, which])})

    keys = ["_qs", "_ts"]
    scored = q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(compare, f"query_id {kinds[0]}, text_id {kinds[1]}, relevance double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("relevance"), "text_id"))
    return scored.withColumn("place", place).filter(F.col("place") <= k)


def merged(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """(offer_id, product_id, sources, distance, relevance): one row per pair, sources sorted, distance and relevance from the
    first source by name that has one."""
    rows = None
    for name, df in sources:
        part = df.select("offer_id", "product_id", F.lit(name).alias("source"), *((F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(c) for c in ("distance", "relevance")))
        rows = part if rows is None else rows.unionByName(part)
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("source")))
    return rows.groupBy("offer_id", "product_id").agg(F.sort_array(F.collect_set("source")).alias("sources"), first("distance").alias("distance"), first("relevance").alias("relevance"))


def missing_sources(offers: DataFrame, stored: DataFrame, sources: list[str]) -> DataFrame:
    """(offer_id, source) that no stored candidate covers, so that only they are retrieved."""
    wanted = offers.select("offer_id", F.explode(F.array(*map(F.lit, sources))).alias("source"))
    return wanted.join(stored.select("offer_id", "source").distinct(), ["offer_id", "source"], "left_anti")


def ranked(candidates: DataFrame) -> DataFrame:
    """With the place by relevance, else by distance, else 0; a distance of zero is a distance."""
    key = F.coalesce(-F.col("relevance"), F.col("distance"), F.lit(0.0))
    return candidates.withColumn("place", F.row_number().over(Window.partitionBy("offer_id").orderBy(key, "product_id")))


def category_estimate(candidates: DataFrame, threshold: float) -> DataFrame:
    """(offer_id, metric, category, share): a category's share of threshold - distance and of relevance among candidates."""
    near = candidates.filter("distance is not null").select("offer_id", "category", F.lit("distance").alias("metric"), F.greatest(threshold - F.col("distance"), F.lit(0.0)).alias("w"))
    relevant_ = candidates.filter("relevance is not null").select("offer_id", "category", F.lit("relevance").alias("metric"), F.col("relevance").alias("w"))
    sums = near.unionByName(relevant_).groupBy("offer_id", "metric", "category").agg(F.sum("w").alias("w"))
    whole = F.sum("w").over(Window.partitionBy("offer_id", "metric"))
    return sums.select("offer_id", "metric", "category", F.when(whole > 0, F.col("w") / whole).alias("share"))


def top_category(estimate: DataFrame) -> DataFrame:
    """The category with the largest share over all metrics; ties by name."""
    best = F.row_number().over(Window.partitionBy("offer_id").orderBy(F.desc("share"), "category", "metric"))
    return estimate.filter("share is not null").withColumn("_p", best).filter("_p = 1").select("offer_id", "category", "share")


def without_long_tail(candidates: DataFrame, top: DataFrame, info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of ordinary categories for offers whose own estimate is ordinary, and (offer_id, outcome) of the offers
    that lose all. `info` has (category, long_tail)."""
    tail = info.filter("long_tail").select("category")
    dropped = top.join(tail, "category", "left_semi").select("offer_id")
    left = candidates.join(dropped, "offer_id", "left_anti").join(tail, "category", "left_anti")
    gone = candidates.select("offer_id").distinct().join(left.select("offer_id").distinct(), "offer_id", "left_anti")
    return left, gone.withColumn("outcome", F.lit("long tail"))


def unverified_machine_pairs(offers: DataFrame, evaluated: DataFrame, relations: list[int]) -> DataFrame:
    """Offers that a machine has paired and no human has evaluated: they must not train the machine."""
    return offers.filter(F.col("relation").isin(relations)).join(evaluated.select("offer_id").distinct(), "offer_id", "left_anti")


def source_statistics(candidates: DataFrame) -> DataFrame:
    """By source and for all: candidates, different products, offers, mean per offer, and exact quantiles of the distance."""
    rows = candidates.withColumn("source", F.explode(F.array(F.col("source"), F.lit("all"))))
    stats = rows.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("n_products"), F.countDistinct("offer_id").alias("n_offers"))
    spread = quantiles(rows, ["source"], "distance", [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])
    return stats.join(spread, "source").withColumn("per_offer", F.col("n") / F.col("n_offers"))


def paired_rank(candidates: DataFrame, offers: DataFrame) -> DataFrame:
    """(source, rank, n): the place of an offer's current product among its candidates by source and at best; -1 if absent."""
    place = F.row_number().over(Window.partitionBy("source", "offer_id").orderBy("distance", "product_id"))
    mine = candidates.withColumn("place", place).join(offers.select("offer_id", F.col("product_id").alias("current")), "offer_id").filter("product_id = current")
    best = mine.groupBy("offer_id").agg(F.min("place").alias("place")).withColumn("source", F.lit("best"))
    found = mine.select("offer_id", "source", "place").unionByName(best.select("offer_id", "source", "place"))
    sources = candidates.select("source").distinct().union(candidates.sparkSession.createDataFrame([("best",)], "source string"))
    names = [r.source for r in sources.collect()]  # as many rows as sources
    every = offers.select("offer_id", F.explode(F.array(*map(F.lit, names))).alias("source"))
    return every.join(found, ["offer_id", "source"], "left").groupBy("source", F.coalesce("place", F.lit(-1)).alias("rank")).agg(F.count("*").alias("n"))


def candidate_lists(candidates: DataFrame) -> DataFrame:
    """(offer_id, by_source, all_products) from (offer_id, product_id, source): products of each source in order, and their union.
    An offer has as many candidates as its sources give at most."""
    each = candidates.groupBy("offer_id", "source").agg(F.sort_array(F.collect_set("product_id")).alias("products"))
    lists = each.groupBy("offer_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "products")))).alias("by_source"))
    return lists.withColumn("all_products", F.sort_array(F.array_distinct(F.flatten(F.map_values("by_source")))))


def still_missing(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Candidate products whose data the catalogue hasn't got yet, once each."""
    return candidates.select("product_id").distinct().join(products.select("product_id"), "product_id", "left_anti")


def present(candidates: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates whose product is still in the catalogue, (offer_id, n, n_left) before and after)."""
    marked = candidates.join(products.select("product_id", F.lit(True).alias("_there")).distinct(), "product_id", "left")
    counts = marked.groupBy("offer_id").agg(F.count("*").alias("n"), F.count("_there").alias("n_left"))
    return marked.filter("_there").drop("_there"), counts


#: Named sources of candidates: functions that give (offer_id, product_id, source, distance or relevance).
SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    """Registers a source of candidates."""
    def add(f: Callable[..., DataFrame]):
        SOURCES[name] = f
        return f

    return add


def retrieved(names: list[str], *arguments) -> DataFrame:
    """Candidates of the named sources, merged."""
    return merged([(name, SOURCES[name](*arguments)) for name in names])
