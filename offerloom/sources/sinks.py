"""Writing reports, topics and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """One table per section of a report."""
    for name, df in sections.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_topics(messages: DataFrame, path: str, bootstrap_servers: str | None = None) -> None:
    """Messages (topic, message) by topic: to folders, or to Kafka where servers are given."""
    if bootstrap_servers:
        messages.select("topic", F.col("message").alias("value")).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()
    else:
        messages.write.mode("append").partitionBy("topic").json(path)


def long_metrics(metrics: DataFrame, source: str) -> DataFrame:
    """(source, statistic, value) rows of a wide table of numbers."""
    values = [c for c in metrics.columns if c != source]
    return metrics.select(source, *(F.col(c).cast("double").alias(c) for c in values)).unpivot([source], values, "statistic", "value").withColumnRenamed(source, "source")


def write_flat(comparisons: DataFrame, path: str, compression: str = "none") -> None:
    """Item x candidate rows as tab-separated text."""
    comparisons.write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", compression).csv(path)


def read_topics(spark: SparkSession, path: str, schema: str, progress: str, out: str) -> DataFrame:
    """All messages of topic folders from the first on, read as a stream until nothing is left. `progress` keeps what has been read,
    so a second call adds only what is new to `out`."""
    stream = spark.readStream.schema(f"{schema}, topic string").json(path)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
