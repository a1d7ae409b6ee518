"""Dropping lines that many documents share.

A line's key is the line without white space at its ends and with A to Z in lower case. Keys of at least LEAST_CHARS code
points that stand in at least LEAST_DOCS documents keep their lines in the document with the largest id only.

1. Lines that are long enough become two 64-bit hashes of their key, with id and position; texts stay where they are.
2. The hashes are range-partitioned and sorted by document (largest first) and position inside a hash, so that first
   occurrences stream by: a row whose predecessor has the same hash but another document begins a document, the first row of
   a hash names the document that keeps its lines. A hash that holds more than its share of the rows is dealt by document to
   blocks of bounded size, each sorted by itself, and its documents are counted by a pre-aggregated count.
3. What has to go is gathered by document as a run-length bitmap: the line numbers at which it changes between keep and drop.
   The bitmaps are the result; only texts that lose a line are moved, to be cut.

Everything is DataFrame functions. Null text is the empty text, which has one empty line. Rows of one id are one document to
the counting (rows with a null id together are one, the smallest), but each text has a bitmap of its own; repeated rows share
one. An empty table gives no bitmaps. Texts and lines of any length are taken whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import parted, saved

LEAST_CHARS, LEAST_DOCS = 40, 5
#: White space that doesn't count at the ends of a line.
SPACES = " \t\n\x0b\x0c\r"
#: A hash with more rows than this, and than its share of all rows, is dealt to blocks of about so many documents. At most
#: SHARES hashes can have more than their share, which bounds what is broadcast about them.
BLOCK_ROWS, SHARES = 1024, 100_000


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def long_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(id, row, place, h1, h2): the lines whose key is long enough. row is a hash of the text."""
    each = docs.select(F.col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("row"), F.posexplode(F.split(_text(text_col), "\n")).alias("place", "line"))
    each = each.filter(F.char_length(F.btrim("line", F.lit(SPACES))) >= least_chars).withColumn("key", key_of(F.col("line")))
    return each.select("id", "row", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(id, row, n_dropped, changes) of the texts that lose a line; all others keep all of theirs. changes: numbers of the
    lines, from 0, at which the bitmap changes, ascending; it begins with keep."""
    lines = saved(long_lines(docs, id_col, text_col, least_chars), "lines")
    share = max(BLOCK_ROWS, lines.count() // SHARES)
    hot = lines.groupBy("h1").agg(F.count("*").alias("n")).filter(F.col("n") > share)
    hot = saved(hot.select("h1", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")), "hot-lines")
    dealt = lines.join(F.broadcast(hot), "h1", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("id"), F.col("blocks")), F.lit(0)))
    of_hot = dealt.filter("blocks is not null").select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("all_docs"), F.max("id").alias("last_id"))

    keys = ["h1", "h2", "block"]
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("id"), "row", "place")
    whole = Window.partitionBy(*keys)
    first = F.row_number().over(order) == 1
    begins = first | ~F.lag("id").over(order).eqNullSafe(F.col("id"))
    ranged = dealt.repartitionByRange(*keys).withColumn("begins", begins)
    counted = ranged.withColumns({"n_docs": F.count_if("begins").over(whole), "top": F.max("id").over(whole)})
    counted = counted.join(F.broadcast(of_hot), ["h1", "h2"], "left")
    n_docs, top = F.coalesce("all_docs", "n_docs"), F.when(F.col("all_docs").isNull(), F.col("top")).otherwise(F.col("last_id"))
    gone = counted.filter((n_docs >= least_docs) & ~top.eqNullSafe(F.col("id")))

    places = gone.groupBy("id", "row").agg(F.sort_array(F.collect_set("place")).alias("p"))
    starts = F.filter("p", lambda x, i: ~F.get("p", i - 1).eqNullSafe(x - 1))
    ends = F.filter("p", lambda x, i: ~F.get("p", i + 1).eqNullSafe(x + 1))
    changes = F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b + 1)))
    return places.select("id", "row", F.size("p").cast("long").alias("n_dropped"), changes.alias("changes"))


def kept_text(text: Column, changes: Column) -> Column:
    """The text's kept lines, joined by a newline."""
    lines = F.split(text, "\n")

    def runs(s: Column) -> Column:
        bounds = F.concat(F.array(F.lit(0)), s["changes"], F.array(F.size(s["lines"])))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["changes"]), F.lit(2)), lambda k: F.slice(s["lines"], F.get(bounds, k) + 1, F.get(bounds, k + 1) - F.get(bounds, k))))

    # a one-element array binds the lines, so that a text is split once
    return F.array_join(F.get(F.transform(F.array(F.struct(lines.alias("lines"), changes.alias("changes"))), runs), F.lit(0)), "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with kept_text, n_lines (before) and n_dropped; columns of these names are replaced. bitmaps: a saved table."""
    ours = ("kept_text", "n_lines", "n_dropped")
    rows = docs.drop(*ours)
    n_lines = F.size(F.split(_text(text_col), "\n")).cast("long")
    same, others = parted(rows, F.xxhash64(_text(text_col)), bitmaps.select("row"))
    untouched = same.select("*", _text(text_col).alias("kept_text"), n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    marked = others.select(F.struct("*").alias("r"), F.col(id_col).alias("of_id"), F.xxhash64(_text(text_col)).alias("of_row"))
    marked = marked.join(bitmaps, (F.col("of_row") == F.col("row")) & F.col("of_id").eqNullSafe(F.col("id")), "left")
    text = F.coalesce(F.col("r")[text_col], F.lit(""))
    cut = marked.select(
        "r.*",
        F.when(F.col("changes").isNull(), text).otherwise(kept_text(text, F.col("changes"))).alias("kept_text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )
    return untouched.unionByName(cut)
