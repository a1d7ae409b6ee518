"""WARC archives with revisit records resolved.

Headers (key, address, size, digest) are grouped by payload digest; of the records with one payload, that with the largest
key keeps it, the others become revisit records that refer to it. Payloads aren't moved: most have a digest of their own,
which a filter of bounded size tells, revisit records need none, and only the originals of repeated payloads are looked up.

Archives are written by Spark's text writer with fresh headers, one record a line and the record separator as line end, so
they go wherever Spark can write (gzip, each file as a whole, no warcinfo record). Reading goes record by record by
Content-Length, whatever a payload holds; revisit records are joined to their originals by WARC-Refers-To, and take page,
size and payload digest from there.

Null payload is the empty payload. Payloads under `least_bytes` are never revisits. Repeated rows: every row that has the
largest key of its payload keeps it. A null key loses to any other; payloads with only null keys all keep theirs. A record's
id is a hash of its key, address, digest and type, so only rows that are equal in all of them share one. An empty table gives
no records. Extra columns are left out.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import parted, saved, shared_path

LEAST_BYTES = 1000
#: Payloads of up to so many bytes are written so many to a file, so that a reader's task has a bounded file before it.
FILES = ((1 << 16, 2_000), (1 << 21, 64), (1 << 62, 1))
END = "\r\n"
#: The HTTP header that goes before each payload, and stands alone in a revisit's block.
HTTP = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}{END}"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def resolve(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """A row for each page: key, url, payload (null for a revisit), payload_bytes, payload_digest, record_type, record_id and
    refers_to (the original's record_id, for a revisit)."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(key_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    headers = rows.drop("payload").filter(F.col("payload_bytes") >= least_bytes)
    # grouped by two columns and joined by one: the join then deals both sides out itself and can split a hot digest
    repeated = headers.groupBy("payload_digest", "payload_bytes").agg(F.max("key").alias("_key"), F.max(F.struct("key", "url")).alias("_original"), F.count("*").alias("_n"))
    repeated = saved(repeated.filter("_n > 1 and _key is not null").select("payload_digest", "_key", F.col("_original.url").alias("_url")), "originals")

    digest = F.xxhash64("payload_digest")
    alone, _ = parted(rows, digest, repeated.select(digest.alias("hash")))
    _, shared = parted(headers, digest, repeated.select(digest.alias("hash")))
    told = shared.join(repeated, "payload_digest", "left")
    revisit = F.col("_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("_key"))
    told = told.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, record_id(F.col("_key"), F.col("_url"), F.lit("response")))})
    told = saved(told.drop("_key", "_url"), "shared-payloads")

    # the payloads of originals, and of rows that came along by chance
    kept = told.filter("record_type = 'response'").select("key", "payload_digest").distinct()
    which = F.xxhash64("key", "payload_digest")
    _, likely = parted(rows.filter(F.col("payload_bytes") >= least_bytes), which, kept.select(which.alias("hash")))
    likely = likely.withColumn("_which", which).join(kept.select(which.alias("_which"), F.col("key").alias("_k"), F.col("payload_digest").alias("_d")), "_which")
    originals = likely.filter(F.col("key").eqNullSafe(F.col("_k")) & (F.col("payload_digest") == F.col("_d"))).drop("_which", "_k", "_d")
    # short payloads are responses, whatever the filter says of their digests
    short = parted(rows.filter(F.col("payload_bytes") < least_bytes), digest, repeated.select(digest.alias("hash")))[1]
    responses = alone.unionByName(short).unionByName(originals).withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("string")})
    revisits = told.filter("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("string"))
    return responses.unionByName(revisits).withColumn("record_id", record_id(F.col("key"), F.col("url"), F.col("record_type")))


def record_id(key: Column, url: Column, record_type: Column) -> Column:
    """A urn:uuid that every reader of the same table gets for the record."""
    told = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    h = F.md5(F.to_json(F.struct(told(key).alias("k"), told(url).alias("u"), F.col("payload_digest").alias("d"), record_type.alias("t"))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def record(date: Column) -> Column:
    """A whole record of a row of resolve(): headers, an empty line, and the block, which has no payload for a revisit."""
    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP), F.coalesce(F.col("payload"), F.lit("")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Date: "), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Page: "), F.col("key").cast("string")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)  # concat_ws passes over nulls


def write_archives(resolved: DataFrame, path: str, date: Column | None = None) -> None:
    """Archives of the records in `path`, by size of the payloads; date: a time in UTC for all records, now if there is none."""
    size, low = F.coalesce(F.octet_length("payload"), F.lit(0)), -1
    for high, records in FILES:
        text = resolved.filter((size > low) & (size <= high)).select(record(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if date is None else date).alias("value"))
        text.write.mode("append").option("lineSep", END + END).option("maxRecordsPerFile", records).option("compression", "gzip").text(path)
        low = high


def parse(archive: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by Content-Length; one record at a time is held."""
    while first := archive.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError("no record where one should begin")
        headers = {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip(END).partition(": ")
            headers[name.lower()] = value
        block = archive.read(int(headers["content-length"]))
        yield headers, block
        archive.read(4)


def read_archives(spark: SparkSession, path: str, key_type: str = "long") -> DataFrame:
    """One row per record: page, url, payload_bytes, payload_digest, record_type, refers_to (a page). The digest of a response is
    computed and held against its header; a revisit's is held against its original's, and an original has to be there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    payload, digest = block.partition(b"\r\n\r\n")[2], headers["warc-payload-digest"].partition(":")[2]
                    revisit = headers["warc-type"] == "revisit"
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
                    rows.append((headers["warc-record-id"], headers.get("warc-refers-to"), headers.get("x-page"), None if revisit else len(payload), digest, headers["warc-type"], headers["warc-target-uri"]))
                columns = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for c, n in zip(columns, names)], names)

    names = ["record_id", "refers_to_id", "page", "payload_bytes", "payload_digest", "record_type", "url"]
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = saved(files.mapInArrow(run, ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names)).withColumn("page", F.col("page").cast(key_type)), "records")
    wanted = rows.filter("refers_to_id is not null").select(F.col("refers_to_id").alias("record_id")).distinct()
    originals = rows.filter("record_type <> 'revisit'").join(wanted, "record_id", "left_semi").groupBy("record_id", F.length("record_id").alias("_"))
    originals = originals.agg(F.max("page").alias("_page"), F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest")).drop("_").withColumnRenamed("record_id", "refers_to_id")
    joined = rows.filter("record_type = 'revisit'").join(originals, "refers_to_id", "left")
    right = F.col("_digest").eqNullSafe(F.col("payload_digest"))
    size = F.when(right, F.col("_bytes")).otherwise(F.raise_error(F.concat(F.lit("no original with its payload for "), F.col("record_id"))).cast("long"))
    out = ["page", "url", "payload_digest", "record_type"]
    revisits = joined.select(*out, size.alias("payload_bytes"), F.col("_page").alias("refers_to"))
    return rows.filter("record_type <> 'revisit'").select(*out, "payload_bytes", F.lit(None).cast(key_type).alias("refers_to")).unionByName(revisits)


def rewritten(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes deduplicated archives to the shared folder and reads them back: one row per page."""
    spark = pages.sparkSession
    path = shared_path(spark, "archives")
    write_archives(resolve(pages, key_col, url_col, payload_col), path)
    back = read_archives(spark, path, pages.schema[key_col].dataType.simpleString())
    return back.select(F.col("page").alias(key_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
