"""Whether a product has been merged into another one, for many pairs of a long history.

Each product was merged into one other at most (of several, the smallest counts), so the history is a forest. A table of jumps
is built by doubling: level k leads from a product to the one 2^k merges later. Jumps that end at a root give each product's
depth. With both depths known, a pair asks for one product only, the one so many merges later, and reaches it by the jumps that
the difference's bits name: as many joins as levels, none of which makes rows. n products have n log n jumps; the closure,
quadratic on chains, isn't built.

Products whose history runs into a cycle have no depth. They are errors of the catalogue and few; their ancestors are followed by
monitoring.merge_ancestors. A product isn't its own ancestor. Null ids are merged into nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.operators.monitoring import merge_ancestors
from offerloom.sources.scratch import saved

#: Levels that are joined before their result is written.
AT_ONCE = 8


@dataclass
class Jumps:
    """levels[k]: (node, up), 2^k merges later; depths: (node, root, depth) of products that aren't roots; endless: (node) of those
    that run into a cycle."""

    levels: list[DataFrame]
    depths: DataFrame
    endless: DataFrame


def jumps(edges: DataFrame) -> Jumps:
    """The table of jumps of merges (child, parent)."""
    parents = edges.filter("child <> parent").groupBy("child").agg(F.min("parent").alias("parent"))
    going = saved(parents.select(F.col("child").alias("node"), F.col("parent").alias("end"), F.lit(1).cast("long").alias("steps")), "jumps")
    n, levels, ended = going.count(), [], going.limit(0)
    while True:
        size = 1 << len(levels)
        levels.append(going.select("node", F.col("end").alias("up")))
        further = going.union(ended).select(F.col("node").alias("end"), F.col("end").alias("next"), F.col("steps").alias("more"))
        rows = saved(going.join(further, "end", "left"), "jumps")
        # a jump that reaches a root has told the depth; it stays to be jumped on
        ended = ended.union(rows.filter("more is null").select("node", "end", "steps")).union(rows.filter(F.col("more") < size).select("node", "next", F.col("steps") + F.col("more")))
        going = rows.filter(F.col("more") == size).select("node", F.col("next").alias("end"), F.col("steps") + F.col("more"))
        going = going.toDF("node", "end", "steps")
        if 2 * size > n or going.isEmpty():
            return Jumps(levels, saved(ended.toDF("node", "root", "depth"), "depths"), going.select("node"))


def merged_into(pairs: DataFrame, edges: DataFrame, table: Jumps | None = None) -> DataFrame:
    """The pairs (product_id, ancestor) of which the first was merged into the second, at once or over others, once each. table:
    jumps(edges), where it is there already."""
    table = table or jumps(edges)
    asked = pairs.select("product_id", "ancestor").filter("product_id <> ancestor").distinct()
    side = lambda name, p: table.depths.select(F.col("node").alias(name), F.col("root").alias(f"{p}root"), F.col("depth").alias(f"{p}depth"))
    rows = asked.join(side("product_id", "a"), "product_id").join(side("ancestor", "b"), "ancestor", "left")
    rows = rows.filter(F.col("aroot") == F.coalesce("broot", "ancestor")).withColumn("left", F.col("adepth") - F.coalesce("bdepth", F.lit(0)))
    rows = saved(rows.filter("left > 0").select("product_id", "ancestor", F.col("product_id").alias("at"), "left"), "lookups")
    for k, level in enumerate(table.levels):
        named = F.pmod(F.shiftright("left", k), F.lit(2)) == 1
        rows = rows.withColumn("node", F.when(named, F.col("at"))).join(level, "node", "left").select("product_id", "ancestor", F.coalesce("up", "at").alias("at"), "left")
        if (k + 1) % AT_ONCE == 0:
            rows = saved(rows, "lookups")
    found = rows.filter("at = ancestor").select("product_id", "ancestor")
    if table.endless.isEmpty():
        return found
    around = edges.join(table.endless.withColumnRenamed("node", "child"), "child", "left_semi").filter("child <> parent").groupBy("child").agg(F.min("parent").alias("parent"))
    return found.union(asked.join(merge_ancestors(around).select("product_id", "ancestor"), ["product_id", "ancestor"], "left_semi"))
