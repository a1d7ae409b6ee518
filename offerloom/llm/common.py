"""Small helpers shared by the operators: reading tables, filters of known size before shuffles, memo tables for words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.sources.scratch import saved, shared_path

__all__ = ["WORD_BREAK", "Memo", "free", "parted", "saved", "set_aside", "shared_path", "table"]

#: White space that separates words; the same five control characters and the space everywhere.
WORD_BREAK = r"[ \t-\r]+"

#: A filter has about so many bits for each hash in it, and between the two sizes (in bits; 32 MB at most). Past the larger
#: size more rows pass than need to, which costs their shuffle and nothing else.
_BITS_EACH, _LEAST_BITS, _MOST_BITS = 16, 1 << 15, 1 << 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken: list[str]) -> str:
    """A name that none of the columns has, whatever their case."""
    lower = {c.lower() for c in taken}
    return next(c for k in range(len(lower) + 1) if (c := f"{name}{k}") not in lower)


def set_aside(rows: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """rows with columns under names that no working column has, and each column by its own name, to be given back."""
    names = {c: f"_own_{k}" for k, c in enumerate(rows.columns)}
    return rows.select(*(F.col(c).alias(n) for c, n in names.items())), {c: F.col(n).alias(c) for c, n in names.items()}


def parted(rows: DataFrame, row_hash: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that surely have none of the hashes, the others): no row moves, so long texts needn't be shuffled to find few.

    hashes: one long column, a saved table. Its bits, a table of a bounded size, are broadcast; a few rows without one of the
    hashes are among the others, so a join has to follow. A null hash counts as none.
    """
    name = hashes.columns[0]
    place_, set_, bits_ = (free(f"_{n}", rows.columns) for n in ("place", "set", "bits"))
    bits = _LEAST_BITS
    wanted = _BITS_EACH * hashes.count()
    while bits < min(wanted, _MOST_BITS):
        bits *= 2
    place = lambda c: F.pmod(c, F.lit(bits))
    sets = hashes.filter(F.col(name).isNotNull()).select(place(F.col(name)).alias(place_))
    sets = sets.groupBy(F.bitmap_bucket_number(place_).alias(set_)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place_)).alias(bits_))
    marked = rows.withColumn(place_, place(row_hash)).withColumn(set_, F.bitmap_bucket_number(place_)).join(F.broadcast(sets), set_, "left")
    at = F.bitmap_bit_position(place_)
    byte = F.conv(F.hex(F.substring(F.col(bits_), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))
    return marked.filter(~hit).select(*rows.columns), marked.filter(hit).select(*rows.columns)


class Memo(dict):
    """What a function gives for a word, kept while a task runs. Bounded: emptied by trim() when it has grown past its limit."""

    def __init__(self, make: Callable[[str], object], limit: int = 600_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= 200:
            self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
