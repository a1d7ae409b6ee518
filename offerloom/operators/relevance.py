"""The k most relevant texts for each query by BM25, exact, with postings that cannot matter left out.

1. Each text becomes a row of hashed words with their counts, words that no query has left out where the queries' words are
   few enough to be sent to all tasks. This table and the one of queries are saved; whatever follows reads them.
2. A first pass gives each word its idf and its largest impact, the word's weight in the text that it tells most about. Times
   the idf, that is the most that the word can add to a score.
3. Seeds: each query looks at its rarest words until they have enough texts, at each word's postings of largest impact first.
   These texts are scored in full; the k-th best score is one that every result has to reach.
4. A query's words of least bound, which even together stay below that score, find no result alone: only postings of its other
   words are looked at, and of these only impacts with which a text could still reach the score. A word's postings are cut by
   impact into levels and inside a level into blocks of bounded size; a block's largest impact tells whether a query needs it.
5. What a text has gathered from these postings and the bounds of the words left out say whether it can reach the score; only
   such texts are scored in full, and the best k stay.

Texts aren't copied for queries: a posting meets the queries that need its block, so a word that all texts have costs nothing
where it cannot decide, and is dealt over many blocks where it can.

Words are compared by 64-bit hashes. A text without words (or null) is relevant to nothing and counts as a text; rows of a
repeated query id are one query, rows of a repeated text id are texts of their own; null ids are ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.sources.scratch import saved

#: Queries' words up to this number (8 bytes each) are sent to all tasks, so that other words don't enter the tables.
MOST_SENT = 1 << 20
#: Texts that a query's rarest words have to have before it stops looking, and postings of a word that are looked at for it.
SEEDS = 256
#: Levels of impact, and postings of a word in a block of a level (on average).
LEVELS, BLOCK = 16, 1024
#: Scores have nine places; bounds are compared with some more room than that.
ROOM = 1e-7


def _counted(texts: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """(t, text_id, length, words, counts): hashes of a text's different words, ascending, with their numbers."""
    hashes = F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    rows = texts.select(F.monotonically_increasing_id().alias("t"), "text_id", hashes.alias("words"))
    wanted = None if vocabulary is None else np.sort(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 1024) for k in range(0, batch.num_rows, 1024)):
                lists = part.column(2)
                words, row = lists.flatten().to_numpy(zero_copy_only=False), lists.value_parent_indices().to_numpy()
                length = np.bincount(row, minlength=part.num_rows)
                if wanted is not None:
                    at = np.searchsorted(wanted, words)
                    known = wanted[np.minimum(at, len(wanted) - 1)] == words if len(wanted) else np.zeros(len(words), bool)
                    words, row = words[known], row[known]
                order = np.lexsort((words, row))
                words, row = words[order], row[order]
                first = np.ones(len(words), bool)
                first[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
                begins = np.nonzero(first)[0]
                counts = np.diff(np.append(begins, len(words)))
                offsets = np.zeros(part.num_rows + 1, np.int32)
                offsets[1:] = np.cumsum(np.bincount(row[begins], minlength=part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(length, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(words[begins], pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts, pa.int32()))],
                    ["t", "text_id", "length", "words", "counts"],
                )

    schema = T.StructType([T.StructField("t", T.LongType()), T.StructField("text_id", texts.schema["text_id"].dataType), T.StructField("length", T.LongType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(count, schema)


def _impact(count: Column, length: Column, mean: float, k1: float, b: float) -> Column:
    return count * (k1 + 1) / (count + k1 * (1 - b + b * length / mean))


def _scores(pairs: DataFrame, asked: DataFrame, counted: DataFrame, mean: float, k1: float, b: float) -> DataFrame:
    """(q, t, text_id, relevance) of pairs (q, t), over all words of the query; to nine places."""
    # a pair is small and its lists aren't: as many parts as asked for, however few bytes the pairs have
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.repartition(parts, "t").join(counted, "t").join(asked.select("q", F.col("words").alias("asked"), "idf"), "q").select("q", "t", "text_id", "length", "words", "counts", "asked", "idf")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            out = np.zeros(batch.num_rows)
            lists = [(c, batch.column(c)) for c in ("words", "counts", "asked", "idf")]
            ends = {c: a.offsets.to_numpy() for c, a in lists}
            values = {c: a.values.to_numpy(zero_copy_only=False) for c, a in lists}
            for k in range(batch.num_rows):
                words, counts, asked, idf = (values[c][ends[c][k] : ends[c][k + 1]] for c, _ in lists)
                at = np.minimum(np.searchsorted(words, asked), len(words) - 1) if len(words) else np.zeros(0, int)
                hit = words[at] == asked if len(words) else np.zeros(0, bool)
                tf = counts[at[hit]]
                out[k] = (idf[hit] * (tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[k] / mean)))).sum() if len(words) else 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("q", "t", "text_id")), pa.array(np.round(out, 9))], ["q", "t", "text_id", "relevance"])

    schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("t", T.LongType()), T.StructField("text_id", counted.schema["text_id"].dataType), T.StructField("relevance", T.DoubleType())])
    return rows.mapInArrow(add, schema)


def most_relevant(queries: DataFrame, texts: DataFrame, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query_id, text_id, relevance, place) of the k most relevant texts for each query, to nine places, ties by text id,
    from (query_id, words) and (text_id, words)."""
    return explained(queries, texts, k, k1, b)["result"]


def explained(queries: DataFrame, texts: DataFrame, k: int, k1: float = 1.2, b: float = 0.75) -> dict[str, DataFrame]:
    """most_relevant's result with the saved tables that lead to it: seeds, bounds (q, reach) and candidates (q, t)."""
    words = F.transform(F.filter("words", lambda w: w.isNotNull()), lambda w: F.xxhash64(w))
    each = queries.select("query_id", F.explode(words).alias("word"))
    asked = saved(each.groupBy("query_id").agg(F.array_sort(F.collect_set("word")).alias("words")).select(F.monotonically_increasing_id().alias("q"), "query_id", "words"), "queries")
    vocabulary = asked.select(F.explode("words").alias("word")).distinct()
    known = [r.word for r in vocabulary.collect()] if vocabulary.limit(MOST_SENT + 1).count() <= MOST_SENT else None  # bounded by the count
    counted = saved(_counted(texts, None if known is None else np.array(known, np.int64)), "texts")
    facts = counted.agg(F.count("*").alias("n"), F.sum("length").alias("words")).first()  # two numbers
    mean = (facts["words"] or 0) / facts["n"] if facts["words"] else 1.0

    each = counted.select("t", "length", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    postings = each.select("t", F.col("x.words").alias("word"), _impact(F.col("x.counts"), F.col("length"), mean, k1, b).alias("impact"))
    facts_of = postings.groupBy("word").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    pairs = asked.select("q", F.explode("words").alias("word"))
    idf = F.log(1 + (F.lit(float(facts["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = saved(pairs.join(facts_of, "word").select("q", "word", "df", idf.alias("idf"), (idf * F.col("most")).alias("bound")), "query-words")
    sized = F.array_sort(F.collect_list(F.struct("word", "idf")))
    asked = saved(wanted.groupBy("q").agg(sized.alias("x"), F.sum("bound").alias("all")).select("q", F.col("x.word").alias("words"), F.col("x.idf").alias("idf"), "all").join(asked.select("q", "query_id"), "q"), "asked")

    # seeds
    enough = max(SEEDS, 8 * k)
    before = F.sum("df").over(Window.partitionBy("q").orderBy("df", "word").rowsBetween(Window.unboundedPreceding, -1))
    rare = saved(wanted.withColumn("before", before).filter(F.coalesce("before", F.lit(0)) < enough).select("q", "word"), "rare-words")
    place = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("impact"), "t"))  # limited in each task before rows meet
    heads = postings.join(rare.select("word").distinct(), "word").withColumn("place", place).filter(F.col("place") <= enough)
    seeds = saved(_scores(saved(rare.join(heads, "word").select("q", "t").distinct(), "seed-pairs"), asked, counted, mean, k1, b), "seeds")
    kth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("relevance"), "t"))
    reach = seeds.withColumn("place", kth).filter(F.col("place") == k).select("q", F.col("relevance").alias("reach"))
    bounds = saved(asked.select("q", "all").join(reach, "q", "left").select("q", "all", (F.coalesce("reach", F.lit(0.0)) - ROOM).alias("reach")), "bounds")

    # words that can find a result, and the least impact that matters; the words left out are those of least bound
    upto = F.sum("bound").over(Window.partitionBy("q").orderBy("bound", "word").rowsBetween(Window.unboundedPreceding, 0))
    split = wanted.join(bounds, "q").withColumn("upto", upto)
    finders = split.filter(F.col("upto") >= F.col("reach")).select("q", "word", "df", "idf", ((F.col("reach") - F.col("all") + F.col("bound")) / F.col("idf")).alias("need"))
    finders = saved(finders, "finders")
    left_out = saved(split.groupBy("q", "reach").agg(F.max(F.when(F.col("upto") < F.col("reach"), F.col("upto"))).alias("rest")).select("q", "reach", F.coalesce("rest", F.lit(0.0)).alias("rest")), "left-out")

    # postings in blocks: levels of impact (below k1 + 1) and parts of a level
    level = F.floor(F.col("impact") / (k1 + 1) * LEVELS).cast("int")
    needed = finders.groupBy("word").agg(F.min("need").alias("least"), F.max("df").alias("df"))
    part = F.pmod(F.xxhash64("t"), F.ceil(F.col("df") / BLOCK)).cast("int")
    blocked = saved(postings.join(needed, "word").filter("impact >= least").select("word", level.alias("level"), part.alias("part"), "t", "impact"), "postings")
    maxima = blocked.groupBy("word", "level", "part").agg(F.max("impact").alias("most"))
    looks = finders.join(maxima, "word").filter("most >= need").select("q", "idf", "need", "word", "level", "part")
    met = looks.join(blocked, ["word", "level", "part"]).filter("impact >= need")
    gathered = met.groupBy("q", "t").agg(F.sum(F.col("idf") * F.col("impact")).alias("got"))
    chosen = saved(gathered.join(left_out, "q").filter(F.col("got") + F.col("rest") >= F.col("reach")).select("q", "t"), "candidates")

    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("relevance"), "text_id", "t"))
    top = _scores(chosen, asked, counted, mean, k1, b).filter("relevance > 0").withColumn("place", best).filter(F.col("place") <= k)
    result = top.join(asked.select("q", "query_id"), "q").select("query_id", "text_id", "relevance", "place")
    return {"result": result, "seeds": seeds, "bounds": bounds, "candidates": chosen, "postings": blocked}
