import corpus_pipeline
from offerloom.llm import registry
from offerloom.llm.common import saved
from tests.llm.test_corpus import plain_join


def test_stages(spark, sf, docs):
    before, rows = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        if name != "packing":
            assert after.columns == docs.columns
            after = saved(after, "stage")
        rows[name] = (before, after)
        before = after
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = rows["quality classifier"][1].join(labels, "doc_id").collect()
    assert sum(r.quality == 1 and r.toxic == 0 for r in kept) > 0.75 * len(kept) and len(kept) > 0.95 * labels.filter("quality = 1 and toxic = 0").join(docs, "doc_id").count()
    a, b = ({r.doc_id for r in x.collect()} for x in rows["quality rules"])
    assert b <= a
    a, b = rows["near-duplicate join"]
    assert {r.doc_id for r in b.collect()} == {int(i) for i, c, _ in plain_join([(r.doc_id, r.text) for r in a.collect()]) if i == c}
    a, b = rows["personal data"]
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in b.collect()} and all(len(r.text) == r.n_chars for r in b.collect())
    pieces = rows["packing"][1].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in rows["packing"][0].collect()}


def test_run_is_registered(spark, sf):
    assert registry.QUERIES["pipeline"] is corpus_pipeline.run and [f"op{n}_" in " ".join(registry.QUERIES) for n in range(1, 11)] == [True] * 10
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_empty(spark, sf, empty):
    docs = empty.select("doc_id", "text").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "0L as n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0, name
