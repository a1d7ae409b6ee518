"""Reading catalogues, logs and feature files, and the catalogue that the supplied tables stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTRIBUTE = T.StructType([T.StructField(n, t) for n, t in (("id", T.LongType()), ("name", T.StringType()), ("value", T.StringType()), ("unit", T.StringType()))])
PRODUCT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("category_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("slug", T.StringType()),
    T.StructField("category", T.StructType([T.StructField("slug", T.StringType())])), T.StructField("prices", T.ArrayType(T.DoubleType())), T.StructField("shops", T.ArrayType(T.LongType())),
    T.StructField("eans", T.ArrayType(T.LongType())), T.StructField("status", T.StructType([T.StructField("id", T.IntegerType())])), T.StructField("attributes", T.ArrayType(ATTRIBUTE)),
])
OFFER = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("offer_name", T.StringType()), T.StructField("match_name", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("ean", T.LongType()), T.StructField("shop_id", T.StringType()), T.StructField("attributes", T.ArrayType(ATTRIBUTE)), T.StructField("parsed_attributes", T.ArrayType(ATTRIBUTE)),
    T.StructField("candidates_sources", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of one or several exports; malformed lines are passed over."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
    return rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def of_categories(rows: DataFrame, categories: list, column: str = "category_id") -> DataFrame:
    """Rows of these categories; all rows for an empty list."""
    return rows.filter(F.col(column).isin(categories)) if categories else rows


def read_offers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Offers with the product id that their file is named for."""
    rows = read_json_lines(spark, paths, OFFER)
    return rows.withColumn("product_id", F.regexp_extract(F.input_file_name(), r"product\.(\d+)\.txt", 1).cast("long"))


def complete_exports(spark: SparkSession, folders: list[str]) -> list[str]:
    """The exports that hold a products file and at least one offer file; the others were broken off and are passed over."""
    jvm = spark.sparkContext._jvm
    out = []
    for folder in folders:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        products, offers = jvm.org.apache.hadoop.fs.Path(at, "products/products.txt"), jvm.org.apache.hadoop.fs.Path(at, "offers")
        if fs.exists(products) and not fs.getFileStatus(products).isDirectory() and fs.exists(offers) and fs.getFileStatus(offers).isDirectory() and len(fs.listStatus(offers)):
            out.append(folder)
    return out


def read_catalogue(spark: SparkSession, folders: list[str], product: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(products, offers) of all complete exports together, with the `export` that a row is from. The first export that has a
    product or an offer of a product gives it."""
    whole = complete_exports(spark, folders)
    if not whole:
        number = T.StructField("export", T.IntegerType())
        return spark.createDataFrame([], T.StructType([*product.fields, number])), spark.createDataFrame([], T.StructType([*OFFER.fields, T.StructField("product_id", T.LongType()), number]))
    products = offers = None
    for number, folder in enumerate(whole):
        p = read_json_lines(spark, f"{folder}/products/products.txt", product).withColumn("export", F.lit(number))
        o = read_offers(spark, f"{folder}/offers").withColumn("export", F.lit(number))
        products, offers = (p, o) if products is None else (products.unionByName(p), offers.unionByName(o))
    first = lambda key: F.min("export").over(Window.partitionBy(key))
    return tuple(df.withColumn("_first", first(key)).filter("export = _first").drop("_first") for df, key in ((products, "id"), (offers, "product_id")))


def of_status(products: DataFrame, offers: DataFrame, statuses: list[int]) -> tuple[DataFrame, DataFrame]:
    """Products of these statuses, and the offers of these products; the others lose theirs."""
    kept = with_status(products, statuses)
    return kept, offers.join(kept.select("product_id"), "product_id", "left_semi")


def read_features(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Feature files as one table; empty files give no rows."""
    return spark.read.schema(schema).option("header", True).csv(paths)


def log_rows(log: DataFrame, time_col: str, since: str, until: str, columns: list[str], limit: int | None = None, seed: int | None = None) -> DataFrame:
    """Log rows of a time range; with a limit the first ones, or random ones in the order of a seeded hash."""
    rows = log.filter(F.col(time_col).between(F.lit(since).cast("timestamp"), F.lit(until).cast("timestamp"))).select(*columns)
    if limit is None:
        return rows
    order = [F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))] if seed is not None else []
    return rows.orderBy(*order, *columns).limit(limit)


def evaluation_window(log: DataFrame, time_col: str, reference: str, gap_days: int = 14, period_days: int = 14) -> DataFrame:
    """Rows of the period that ended `gap_days` before the reference date."""
    until = F.date_sub(F.lit(reference).cast("date"), gap_days).cast("timestamp")
    since = F.date_sub(F.lit(reference).cast("date"), gap_days + period_days).cast("timestamp")
    return log.filter((F.col(time_col) >= since) & (F.col(time_col) < until))


def first_per_group(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("_at", at).filter(F.col("_at") <= n).drop("_at")


def rows_for_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    return rows.join(ids.select(column).distinct(), column, "left_semi")


def pick_one(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """One random row, the same for the same seed."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(1)


def numbered(rows: DataFrame, order: str, most: int) -> DataFrame:
    """The first rows in a total order, with their numbers from 0."""
    first = rows.orderBy(order).limit(most)
    return first.withColumn("number", F.row_number().over(Window.orderBy(order)) - 1)


def with_status(products: DataFrame, statuses: list[int]) -> DataFrame:
    return products.filter(F.col("status").isin(statuses))


def with_enough_offers(products: DataFrame, offers: DataFrame, least: int) -> DataFrame:
    counts = offers.groupBy("product_id").count().filter(F.col("count") >= least).select("product_id")
    return products.join(counts, "product_id", "left_semi")


def missing_fields(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, missing) and a row `total` for rows with any field missing."""
    any_missing = None
    for c in columns:
        any_missing = F.col(c).isNull() if any_missing is None else any_missing | F.col(c).isNull()
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns), F.count_if(any_missing).alias("total"))
    return counts.unpivot([], [*columns, "total"], "field", "missing")


def validated(rows: DataFrame, required: list[str], casts: dict[str, str]) -> DataFrame:
    """rows with is_valid and invalid_reason; nothing is dropped."""
    reason = F.lit(None).cast("string")
    for c, kind in reversed(casts.items()):
        reason = F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(f"{c} is not {kind}")).otherwise(reason)
    for c in reversed(required):
        reason = F.when(F.col(c).isNull(), F.lit(f"{c} is missing")).otherwise(reason)
    return rows.withColumn("invalid_reason", reason).withColumn("is_valid", F.col("invalid_reason").isNull())


# --- the catalogue that the supplied tables stand for ---


def offer_id() -> Column:
    """A hash of the columns that together tell line items apart."""
    cents = lambda c: F.round(F.col(c) * 100).cast("long").cast("string")
    return F.md5(F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), cents("l_quantity"), cents("l_extendedprice")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("product_id"),
        F.col("p_type").alias("category"),
        F.concat_ws(" ", "p_name", "p_brand", F.concat(F.col("p_size").cast("string"), F.lit("kg"))).alias("name"),
        F.col("p_name").alias("short_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.round("p_retailprice", 2).alias("price"),
        (key % 4).cast("int").alias("status"),
        F.when(key % 3 == 0, key * 7 + 1).alias("ean"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as offers, with nothing of their part yet: what is moved to it. `id` is the offer's id in 16 bytes."""
    price = (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100).alias("price")
    return table(spark, sf_dir, "lineitem").select(F.unhex(offer_id()).alias("id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("shop"), price, F.col("l_shipdate").alias("time"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as offers of their part, with a title that differs from the product's in a way that the id decides."""
    return titled(spark, sf_dir, lines(spark, sf_dir)).select("offer_id", "product_id", "category", "shop", "price", "time", "name", "ean")


def titled(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows of lines with offer_id, category, brand, name and ean."""
    p = products(spark, sf_dir).select("product_id", "category", "short_name", "brand", "size", "ean")
    more = [c for c in rows.columns if c != "id"]
    o = rows.join(p, "product_id").withColumn("offer_id", F.lower(F.hex("id")))
    nibble = F.substring("offer_id", 1, 1)
    kg = F.concat(F.col("size").cast("string"), F.lit("kg"))
    title = (
        F.when(nibble < "8", F.concat_ws(" ", "short_name", "brand", kg))
        .when(nibble < "a", F.concat_ws(" ", "brand", "short_name", kg))
        .when(nibble < "c", F.concat_ws(" ", "short_name", "brand", F.concat((F.col("size") * 1000).cast("string"), F.lit("g"))))
        .when(nibble < "e", F.concat_ws(" ", "short_name", kg))
        .otherwise(F.concat_ws(" ", F.concat(F.lit("x"), F.expr("substring(short_name, 2)")), "brand", kg))
    )
    own_ean = F.when(F.substring("offer_id", 2, 1) < "8", F.col("ean")).when(F.substring("offer_id", 2, 1) < "a", F.col("product_id") * 7 + 2)
    return o.select("offer_id", *more, "category", "brand", title.alias("name"), own_ean.alias("ean"))
