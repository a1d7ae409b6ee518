"""The batch decision flow on micro-batches: one code path for both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from offerloom.sources.scratch import saved

TRIES, MINUTES = 5, 190


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once_each(offers: DataFrame, time_col: str = "ts", key: str = "offer_id") -> DataFrame:
    """An offer id that comes again within the retry time is taken once."""
    return offers.withWatermark(time_col, f"{MINUTES} minutes").dropDuplicatesWithinWatermark([key])


#: A batch of up to so many offers is sent to all tasks to look for it in the catalogue.
MOST_SENT = 100_000


def split_batch(batch: DataFrame, catalogue: DataFrame, key: str = "offer_id") -> tuple[DataFrame, DataFrame]:
    """(offers that the catalogue has, ids that it doesn't have and that are only acknowledged). Null ids are unknown.

    The catalogue is read once and isn't shuffled for a batch of bounded size: the batch's ids are sent to it."""
    batch = saved(batch, "batch")
    ids = batch.select(key).distinct()
    few = ids.limit(MOST_SENT + 1).count() <= MOST_SENT
    there = catalogue.select(key).join(F.broadcast(ids) if few else ids, key, "left_semi").distinct().withColumn("_there", F.lit(True))
    marked = saved(batch.join(F.broadcast(there) if few else there, key, "left"), "marked")
    return marked.filter("_there").drop("_there"), marked.filter("_there is null").select(key)


def retries(failed: DataFrame, time_col: str = "first_seen", now: str | None = None) -> DataFrame:
    """Failed rows (with `tries`) that are tried again: not too often and not too late."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return failed.filter((F.col("tries") < TRIES) & (F.col(time_col) >= at - F.expr(f"INTERVAL {MINUTES} MINUTES"))).withColumn("tries", F.col("tries") + 1)


def run_batches(stream: DataFrame, decide: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch goes through `decide` and into topic folders; a batch that is repeated replaces its own folder, so
    that a restart leaves no row twice."""

    def write(batch: DataFrame, number: int) -> None:
        decide(batch).write.mode("overwrite").partitionBy("topic").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_routed(stream: DataFrame, routes: Callable[[], DataFrame], decide: Callable[[DataFrame], DataFrame], catalogue: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The decision flow with its branches. Each micro-batch reads the routes (category, model) anew, so that a change of routes
    holds from the next batch on. Offers that the catalogue hasn't got are acknowledged (`not-found`); offers of categories
    without a model are `unsupported`; the others are decided (offer_id, topic); what `decide` gives no row for is queued again
    (`retry`). A batch that is repeated replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        found, unknown = split_batch(batch, catalogue)
        routed = found.join(routes(), "category", "left")
        supported = routed.filter("model is not null")
        decided = decide(supported).select("offer_id", "topic")
        left = supported.select("offer_id").join(decided.select("offer_id"), "offer_id", "left_anti")
        parts = [decided, *(rows.select("offer_id", F.lit(name).alias("topic")) for rows, name in ((routed.filter("model is null"), "unsupported"), (unknown, "not-found"), (left, "retry")))]
        rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
        rows.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What becomes of an offer before it is decided, and the topic that tells of it.
NO_CANDIDATES, NO_CATEGORY, LONG_TAIL, NO_MODEL, DECIDE = "no-candidates", "unknown", "acknowledged", "unsupported", "decide"


def branched(offers: DataFrame, candidates: DataFrame, categories: DataFrame, long_tail: DataFrame, routes: DataFrame) -> DataFrame:
    """offers (offer_id) with category, model and `branch`, the first that holds: without candidates (offer_id), without an estimated
    category (offer_id, category), of a long-tail category (category), of a category without a model (category, model); all
    others are decided."""
    has = candidates.select("offer_id", F.lit(True).alias("_has")).distinct()
    rows = offers.drop("category", "model").join(has, "offer_id", "left").join(categories.select("offer_id", "category"), "offer_id", "left")
    rows = rows.join(long_tail.select("category", F.lit(True).alias("_tail")).distinct(), "category", "left").join(routes.select("category", "model"), "category", "left")
    branch = F.when(F.col("_has").isNull(), NO_CANDIDATES).when(F.col("category").isNull(), NO_CATEGORY).when(F.col("_tail"), LONG_TAIL).when(F.col("model").isNull(), NO_MODEL).otherwise(DECIDE)
    return rows.withColumn("branch", branch).drop("_has", "_tail")


def run_branched(stream: DataFrame, look_up: Callable[[DataFrame], tuple[DataFrame, DataFrame]], long_tail: Callable[[], DataFrame], routes: Callable[[], DataFrame], decide: Callable[[DataFrame], DataFrame], catalogue: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The whole flow of a micro-batch: offers that the catalogue hasn't got are `not-found`; for the others look_up gives
    (candidates, categories), and each goes its branch. decide (offer_id, topic) sees those that are left, with category and
    model; what it has no row for is queued again (`retry`). Long tail and routes are read anew for each batch."""

    def write(batch: DataFrame, number: int) -> None:
        found, unknown = split_batch(batch, catalogue)
        rows = saved(branched(found, *look_up(found), long_tail(), routes()), "branched")
        to_decide = rows.filter(F.col("branch") == DECIDE)
        decided = saved(decide(to_decide).select("offer_id", "topic"), "decided")
        left = to_decide.join(decided, "offer_id", "left_anti").select("offer_id", F.lit("retry").alias("topic"))
        told = rows.filter(F.col("branch") != DECIDE).select("offer_id", F.col("branch").alias("topic"))
        every = decided.unionByName(told).unionByName(left).unionByName(unknown.select("offer_id", F.lit("not-found").alias("topic")))
        every.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_counts(events: DataFrame, labels: list[str], minutes: int = 60, late: int = MINUTES, time_col: str = "ts") -> DataFrame:
    rows = events.withWatermark(time_col, f"{late} minutes").groupBy(F.window(time_col, f"{minutes} minutes").alias("w"), *labels)
    return rows.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *labels, "n")


def histogram(rows: DataFrame, value: str, low: float, high: float, buckets: int) -> DataFrame:
    """(bucket, n) with fixed buckets; 0 is below, buckets + 1 is at or above the end."""
    return rows.groupBy(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))
