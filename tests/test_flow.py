"""Branches of the stream, routes that change between batches, and catalogue exports of which some are broken off."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.sources import catalog
from offerloom.streaming import decisions


def test_branches_in_order(spark):
    offers = spark.createDataFrame([(k,) for k in range(7)], "offer_id long")
    candidates = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 4, 5)], "offer_id long")
    categories = spark.createDataFrame([(2, "a"), (3, "tail"), (4, "none"), (5, "a"), (6, "a")], "offer_id long, category string")
    routes = spark.createDataFrame([("a", "m"), ("tail", "t")], "category string, model string")
    rows = decisions.branched(offers, candidates, categories, routes.filter("category = 'tail'"), routes).collect()
    assert {r.offer_id: r.branch for r in rows} == {0: "no-candidates", 1: "unknown", 2: "decide", 3: "acknowledged", 4: "unsupported", 5: "decide", 6: "no-candidates"} and len(rows) == 7


def test_routes_change_between_batches(spark, tmp_path):
    """A category that gets a model after the first batch is decided in the second; a repeated run does nothing again."""
    folder, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    made = []

    def routes():
        made.append(1)
        return spark.createDataFrame([("a", "m")] if len(made) == 1 else [("a", "m"), ("b", "n")], "category string, model string")

    def look_up(batch):
        return batch.select("offer_id"), batch.select("offer_id", F.col("estimate").alias("category"))

    catalogue = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5)], "offer_id long")
    none = spark.createDataFrame([], "category string")
    decide = lambda batch: batch.filter("offer_id <> 5").select("offer_id", F.concat(F.lit("by-"), "model").alias("topic"))
    schema = "offer_id long, estimate string"
    for rows in ([(1, "a"), (2, "b"), (9, "a")], [(3, "a"), (4, "b"), (5, "b")], []):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        decisions.run_branched(spark.readStream.schema(schema).parquet(folder), look_up, lambda: none, routes, decide, catalogue, out, progress).awaitTermination()
    got = sorted((r.offer_id, r.topic, r.batch) for r in spark.read.option("basePath", out).parquet(f"{out}/batch=*").collect())
    assert got == [(1, "by-m", 0), (2, "unsupported", 0), (3, "by-m", 1), (4, "by-n", 1), (5, "retry", 1), (9, "not-found", 0)] and len(made) == 2


def test_exports(spark, tmp_path):
    product = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])

    def export(name, products=None, offers=None):
        folder = tmp_path / name
        folder.mkdir()
        if products is not None:
            (folder / "products").mkdir()
            (folder / "products" / "products.txt").write_text("\n".join(json.dumps({"id": i, "name": name}) for i in products))
        if offers is not None:
            (folder / "offers").mkdir()
            for i in offers:
                (folder / "offers" / f"product.{i}.txt").write_text(json.dumps({"id": i * 10, "name": name}))
        return str(folder)

    folders = [export("a", [1, 2], [1, 2]), export("no-offers", [3], []), export("no-folder", [4]), export("no-products", None, [5]), export("b", [2, 6], [2, 6]), str(tmp_path / "absent")]
    assert catalog.complete_exports(spark, folders) == [folders[0], folders[4]]
    products, offers = catalog.read_catalogue(spark, folders, product)
    assert sorted((r.id, r.name, r.export) for r in products.collect()) == [(1, "a", 0), (2, "a", 0), (6, "b", 1)]
    assert sorted((r.id, r.product_id, r.name) for r in offers.collect()) == [(10, 1, "a"), (20, 2, "a"), (60, 6, "b")]
    none = catalog.read_catalogue(spark, folders[1:4], product)
    assert none[0].count() == none[1].count() == 0 and none[1].columns == offers.columns
