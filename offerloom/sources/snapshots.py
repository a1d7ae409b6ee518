"""Versioned snapshots by category that are there as a whole or not at all.

Rows are written to a folder of their own first. A snapshot exists from the moment at which its manifest does: a small file that
names the folder and the version of each category. Manifests are numbered, and a number can be created once only, so of two
writers the second finds its number taken, looks at the versions anew and takes the next. What a writer leaves that is stopped
before its manifest is no snapshot; nobody reads it, and sweep() removes it. A manifest that isn't complete counts as none.

The store needs to create a file only where there is none, as HDFS and local file systems do. A manifest has a row for each
category, and a store one manifest for each snapshot; both are read by the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: An error if more than this share of the wanted categories has no rows; it mostly means that something is wrong.
MOST_MISSING = 0.8


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def manifests(spark: SparkSession, path: str) -> list[tuple[int, dict | None]]:
    """(number, manifest) in order; None for one that isn't complete."""
    fs, at = _files(spark, path)
    folder = at(f"{path}/manifests")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.isdigit():
            continue
        stream = fs.open(status.getPath())
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            manifest = json.loads(text)
        except ValueError:
            manifest = None
        out.append((int(name), manifest if manifest and manifest.get("complete") else None))
    return sorted(out, key=lambda x: x[0])


def versions(spark: SparkSession, path: str) -> dict[str, int]:
    """The latest version of each category."""
    latest: dict[str, int] = {}
    for _, manifest in manifests(spark, path):
        for category, version in (manifest or {}).get("versions", {}).items():
            latest[category] = max(version, latest.get(category, version))
    return latest


def staged(rows: DataFrame, path: str) -> str:
    """Rows by category in a folder that no snapshot names yet."""
    folder = uuid.uuid4().hex
    rows.write.partitionBy("category").parquet(f"{path}/data/{folder}")
    return folder


def committed(spark: SparkSession, path: str, folder: str, categories: list[str]) -> dict[str, int]:
    """The versions under which the folder's rows are there from now on."""
    fs, at = _files(spark, path)
    while True:
        before = manifests(spark, path)
        number = before[-1][0] + 1 if before else 0
        latest = versions(spark, path)
        new = {c: latest.get(c, -1) + 1 for c in categories}
        try:
            stream = fs.create(at(f"{path}/manifests/{number:012}"), False)
        except Exception as error:
            if "AlreadyExists" not in str(error) and "already exists" not in str(error):
                raise
            continue  # another writer was faster
        try:
            stream.write(bytearray(json.dumps({"folder": folder, "versions": new, "complete": True}).encode()))
        finally:
            stream.close()
        return new


def write(rows: DataFrame, wanted: list[str], path: str, most_missing: float = MOST_MISSING) -> dict[str, int]:
    """A new version of each wanted category; those without rows get an empty one. Rows of other categories, and without a
    category, are left out."""
    spark = rows.sparkSession
    folder = staged(rows.filter(F.col("category").isin(wanted)), path)
    have = {r.category for r in _read(spark, path, folder, rows).select("category").distinct().collect()}  # as many as wanted
    missing = len(set(wanted) - have)
    if missing > most_missing * len(set(wanted)):
        raise ValueError(f"{missing} of {len(set(wanted))} categories have no rows")
    return committed(spark, path, folder, sorted(set(wanted)))


def _read(spark: SparkSession, path: str, folder: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{path}/data/{folder}")


def read(spark: SparkSession, path: str, like: DataFrame, version: dict[str, int] | None = None) -> DataFrame:
    """Rows of the latest version of each category, or of the versions asked for, with their `version`. like: a table with the
    rows' columns."""
    asked, out = version if version is not None else versions(spark, path), None
    for _, manifest in manifests(spark, path):
        here = {c: v for c, v in (manifest or {}).get("versions", {}).items() if asked.get(c) == v}
        if here:
            of = F.create_map(*(F.lit(x) for kv in here.items() for x in kv))
            part = _read(spark, path, manifest["folder"], like).filter(F.col("category").isin(list(here))).withColumn("version", F.element_at(of, F.col("category")))
            out = part if out is None else out.unionByName(part)
    return like.limit(0).withColumn("version", F.lit(0)) if out is None else out


def sweep(spark: SparkSession, path: str) -> int:
    """Removes folders that no manifest names, and says how many. No writer may be at work."""
    fs, at = _files(spark, path)
    named = {m["folder"] for _, m in manifests(spark, path) if m}
    data = at(f"{path}/data")
    stray = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName() not in named] if fs.exists(data) else []
    for folder in stray:
        fs.delete(folder, True)
    return len(stray)
