"""Fill-in-middle: a text is cut into prefix, middle and suffix between units, and its parts change places.

One fullmatch of `(unit)*` by the regex library keeps every repetition of the group, so ends(1) gives the number of units
and the places at which a text may be cut, without a loop over the units.

Where a document is cut, and in which form it goes out, depend on a seed and its id alone. Forms: psm is prefix, suffix,
middle; spm is suffix, prefix, middle, each part after its marker; plain is the text itself, which texts keep that are empty,
hold a marker, aren't a sequence of units, or aren't drawn. Markers aren't in the parts of the other forms, so the first
occurrence of each tells where a part ends.

Null text is the empty text; a null id is drawn as the empty string. Repeated rows come out alike, an empty table stays
empty, texts of any length are matched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines with their newline; the last may have none.
LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = MARKERS = "<P>", "<S>", "<M>"
#: Rows that leave a worker at once.
ROWS = 256


def cuts(units: regex.Pattern, text: str, a: int, b: int) -> tuple[int, int, int] | None:
    """(number of units, ends of prefix and of middle in code points) for two drawn numbers; None if the units don't cover
    the text."""
    match = units.fullmatch(text)
    if match is None:
        return None
    ends = match.ends(1)
    n = len(ends)
    low, high = sorted((a % (n + 1), b % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def rearranged(text: str, form: str, start: int, stop: int) -> str:
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, percent_spm: int = 50, unit: str = LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for each row; chars are null if the form is plain. n is null where
    the units don't cover the text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), digest.alias("digest"))

    def one(text: str, digest: str, units: regex.Pattern) -> tuple:
        a, b, drawn, kind = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
        cut = cuts(units, text, a, b)
        if cut is None:
            return None, "plain", None, None, text
        n, start, stop = cut
        if not text or drawn % 100 >= percent or any(m in text for m in MARKERS):
            return n, "plain", None, None, text
        form = "spm" if kind % 100 < percent_spm else "psm"
        return n, form, start, stop - start, rearranged(text, form, start, stop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for part in (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS)):
                columns = zip(*(one(text, digest, units) for text, digest in zip(part.column(1).to_pylist(), part.column(2).to_pylist())))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(body, second, 1)
        rest = F.substr(body, F.char_length(a) + len(second) + 1)
        b = F.substring_index(rest, MIDDLE, 1)
        return a, b, F.substr(rest, F.char_length(b) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
