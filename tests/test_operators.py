"""Facts about single operators that no query shows."""

import pytest
from pyspark.sql import functions as F

from offerloom.functions import prices, text
from offerloom.operators import candidates, dataset, decisions, evaluation, features, monitoring
from offerloom.sources import catalog
from offerloom.streaming import decisions as streaming


@pytest.mark.parametrize("low,high,price,rejected", [(100, 130, 70, False), (100, 130, 250, False), (100, 130, 1440, True), (1000, 1300, 200, True), (1000, 1300, 6000, True), (20000, 21300, 26000, False), (20000, 21300, 60000, True), (100, 130, 110, None), (None, None, 5, None)])
def test_price_rule(spark, low, high, price, rejected):
    row = spark.createDataFrame([(low, high, float(price))], "low double, high double, p double") if low is None else spark.createDataFrame([(float(low), float(high), float(price))], "low double, high double, p double")
    assert row.select(prices.price_rejected(F.col("low"), F.col("high"), F.col("p")).alias("r")).first().r is rejected


def test_constant_rule(spark):
    rows = spark.createDataFrame([(1.0, 2.5, 1), (2.0, 0.5, 1), (2.0, 8.0, 1), (2.0, 0.4, 0), (2.0, 9.0, 0)], "c double, p double, want int")
    for r in rows.collect():
        got = spark.range(1).select(prices.constant_outlier(F.lit(1.0), F.lit(4.0), F.lit(r.p), r.c).alias("x")).first().x
        assert got == r.want


def test_bartlett_tail(spark):
    from math import erfc, sqrt

    got = [r.p for r in spark.createDataFrame([(0.5,), (3.84,)], "t double").select(prices.chi2_tail("t").alias("p")).collect()]
    assert got == pytest.approx([erfc(sqrt(0.25)), 0.05004], abs=1e-4)


def test_leave_one_out(spark):
    import statistics

    rows = [("a", float(p)) for p in (3, 1, 4, 1, 5)] + [("b", 2.0)]
    df = spark.createDataFrame([(k, p, x) for k, (p, x) in enumerate(rows)], "offer_id long, product_id string, price double")
    for r in features.leave_one_out_prices(df).collect():
        rest = [x for k, (p, x) in enumerate(rows) if p == r.product_id and k != r.offer_id]
        assert r.others_n == len(rest) and r.others_low == (min(rest) if rest else None) and r.others_high == (max(rest) if rest else None)
        if len(rest) > 1:
            assert r.others_m2 == pytest.approx(statistics.pvariance(rest) * len(rest))


def test_one_edit(spark):
    cases = [("abcd", "abdc", True), ("abcd", "abc", True), ("abcd", "abcde", True), ("abcd", "xbcd", True), ("abcd", "badc", False), ("a", "b", True), ("abcd", "abcd", False), ("ab", "cd", False), ("a1", "a2", False), ("a1", "ab", True)]
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", features.one_edit_makes(F.col("a"), F.col("b"))).collect())


def edits_of(title):
    """Every title one edit away: a character left out, swapped with its neighbour, or a letter in its place or before it."""
    import string

    for i in range(len(title) + 1):
        yield from (title[:i] + c + title[i:] for c in string.ascii_lowercase)
        if i < len(title):
            yield title[:i] + title[i + 1 :]
            yield from (title[:i] + c + title[i + 1 :] for c in string.ascii_lowercase)
        if i + 1 < len(title):
            yield title[:i] + title[i + 1] + title[i] + title[i + 2 :]


def test_subset_grade_against_all_edits(spark):
    """Titles of letters, digits and spaces, edited across spaces, with repeated, empty and one-letter words."""
    import random

    rng, rows = random.Random(2), [("", ""), ("", "x"), ("x", ""), ("a", "a b"), ("ab", "a b"), ("acb", "a b"), ("a1b", "a b"), ("1kg", "2kg"), ("a bc", "ab c"), ("", "a  b"), ("aa", "a a"), ("a aa", "a a a")]
    title = lambda: " ".join("".join(rng.choice("ab1") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 4)))
    for _ in range(700):
        b = title()
        if rng.random() < 0.3:
            a = title()
        else:
            near = rng.choice(sorted(edits_of(b))).split(" ") if rng.random() < 0.7 else b.split(" ")
            a = " ".join(rng.sample(near, rng.randint(1, len(near))))
        rows.append((a, b))
    grades = []
    for r in spark.createDataFrame(rows, "a string, b string").withColumn("g", features.subset_grade(F.col("a"), F.col("b"))).collect():
        need = set(r.a.split(" "))
        want = 2 if need <= set(r.b.split(" ")) else int(any(need <= set(e.split(" ")) for e in edits_of(r.b)))
        assert r.g == want, r
        grades.append(r.g)
    assert min(map(grades.count, (0, 1, 2))) > 50


def test_offer_decisions(spark):
    rows = [(1, 1, "yes", "name", 0), (1, 2, "yes", "score", 0), (2, 1, "yes", "score", 3), (3, 1, "yes", "score", 0), (3, 2, "yes", "score", 1), (4, 1, "no", "price", 0), (5, 1, "yes", "score", 0), (5, 2, "yes", "score", 2), (6, 1, "yes", "score", 9), (6, 2, "yes", "score", 2)]
    df = spark.createDataFrame(rows, "offer_id int, product_id int, decision string, reason string, status int")
    out = decisions.serving_decision(decisions.name_priority(decisions.status_priority(df, {0: 1, 1: 1, 2: 2, 3: 3}, {3})))
    assert {r.offer_id: (r.final_decision, r.final_product) for r in out.collect()} == {1: ("yes", 1), 2: ("unknown", None), 3: ("unknown", None), 4: ("no", None), 5: ("yes", 1), 6: ("unknown", None)}


def test_coverage_and_alert(spark):
    counts = [("m_1", "matched", 2), ("m_2", "matched", 3), ("m_1", "unknown", 8), ("m_2", "unknown", 13), ("m_3", "unknown", 21), ("m_1", "new", 34), ("m_3", "new", 75), ("m_4", "new", 109), ("", "new", 5)]
    rows = monitoring.coverage(spark.createDataFrame(counts, "model string, outcome string, n long"))
    assert {r.model: r.coverage for r in rows.collect()} == {"m_1": 0.82, "m_2": 0.19, "m_3": 0.78, "m_4": 1.0, "total": 0.84}
    limits = spark.createDataFrame([("coverage", "below", 0.75, "warning")], "metric string, direction string, bound double, level string")
    metrics = rows.select("model", F.lit("coverage").alias("metric"), F.col("coverage").alias("value"))
    assert [r.model for r in monitoring.alerts(metrics, limits).collect()] == ["m_2"] and monitoring.alerts(metrics, limits, days=2).count() == 0


def test_gate_and_cycles(spark):
    metrics = spark.createDataFrame([("precision", 0.96), ("coverage", 0.8)], "metric string, value double")
    gate = lambda *rows: monitoring.passes_gate(metrics, spark.createDataFrame(rows, "metric string, least double")).first().passes
    assert gate(("precision", 0.95)) and not gate(("precision", 0.95), ("coverage", 0.83)) and not gate(("absent", 0.1))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "child long, parent long")
    assert {(r.product_id, r.ancestor) for r in monitoring.merge_ancestors(edges).collect()} >= {(1, 2), (1, 3), (4, 3)}


def test_ancestors_of_any_depth(spark):
    chain = {(i, i + 1) for i in range(45)}
    ways = {(0, 10), (10, 30), (50, 51), (51, 52), (52, 50), (60, 60), (7, 50)}
    edges = spark.createDataFrame(sorted(chain | ways), "child long, parent long")
    want = {}
    for start in range(61):
        front, steps = {start}, 0
        while front:
            steps += 1
            front = {b for a, b in chain | ways if a in front} - {start} - {a for s, a in want if s == start}
            want |= {(start, a): steps for a in front}
    rows = monitoring.merge_ancestors(edges).collect()
    assert {(r.product_id, r.ancestor): r.steps for r in rows} == want and len(rows) == len(want)


def test_matched_metrics_use_all_ancestors(spark, monkeypatch):
    from offerloom.plans import logs

    seen, judge = [], monitoring.evaluated_matches
    monkeypatch.setattr(monitoring, "evaluated_matches", lambda log, now, up: seen.append(up) or judge(log, now, up))
    logs.matched_metrics(spark, "/root/testdata/sf0.001")
    up = {(r.product_id, r.ancestor) for r in seen[0].select("product_id", "ancestor").collect()}
    want = set()
    for e in spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_type IN ('click', 'view') AND event_id % 6 < 5").collect():
        now, at = e.user_id >> (e.event_id % 6), e.user_id
        while at > 1 and at % 5 and at != now:  # others have no parent
            at //= 2
        if at == now != e.user_id:
            want.add((e.user_id, now))
    assert up == want and {(8, 4), (8, 1), (14, 7)} <= up and not {(11, 2), (10, 5)} & up
    log = spark.createDataFrame([(1, "m", 8, "c", "name")], "offer_id long, model string, final_product long, category string, by string")
    assert judge(log, spark.createDataFrame([(1, 1, "c")], "offer_id long, product_id long, category string"), seen[0]).first().correct


def test_dictionary_values_of_any_length(spark):
    from pyspark.sql import Row

    entries = [("a", "model", "one two three four five", "g1"), ("a", "colour", "two", "g2"), ("b", "colour", "two", "g3"), ("b", "model", "one two", "g4"), ("a", "size", "three four five six", "g5")]
    dictionary = spark.createDataFrame(entries, "category string, name string, value string, group_id string")
    titles = {1: ("a", "zero one two three four five"), 2: ("b", "zero one two three four five"), 3: ("a", "three four five six"), 4: ("a", ""), 5: ("c", "two"), 6: ("a", "one three two four five")}
    rows = spark.createDataFrame([Row(id=k, category=c, words=t.split()) for k, (c, t) in titles.items()], "id int, category string, words array<string>")
    want = {}
    for k, (c, t) in titles.items():
        for category, name, value, group in entries:
            if category == c and f" {value} " in f" {t} ":
                want.setdefault((k, c, name), set()).add(group)
    assert {(r.id, r.category, r["name"]): set(r.groups) for r in features.dictionary_attributes(rows, dictionary, "id", "words").collect()} == want
    assert (1, "a", "model") in want and (3, "a", "size") in want


def test_words_of_any_script(spark, tmp_path):
    from offerloom.plans import logs

    texts = ["Größe 42 für die Straße, größe!", "déjà vu à l'été", "Привет, мир", "हिन्दी भाषा", "", None]
    want = [["größe", "42", "für", "die", "straße", "größe"], ["déjà", "vu", "à", "l", "été"], ["привет", "мир"], ["हिन्दी", "भाषा"], [], []]
    docs = spark.createDataFrame([(i, t, f"l{i}") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert [r.w for r in docs.orderBy("doc_id").select(text.any_script_words(F.col("text")).alias("w")).collect()] == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.filter("doc_id in (0, 2)").selectExpr("doc_id as item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {(r.category, r.word, r.n) for r in logs.characteristic_words(spark, str(tmp_path)).collect()} == {(f"l{i}", w, ws.count(w)) for i, ws in enumerate(want) for w in ws}
    assert {(r.query_id, r.text_id) for r in logs.token_candidates(spark, str(tmp_path)).collect()} == {(0, 0), (2, 2)}


def test_every_offer_and_order_counts(spark):
    from offerloom.plans import more

    sf = "/root/testdata/sf0.001"
    o = catalog.offers(spark, sf).select("offer_id", "product_id").collect()
    sizes = {}
    for r in o:
        sizes[r.product_id] = sizes.get(r.product_id, 0) + 1
    want = {r.offer_id: sizes[r.product_id] - 1 for r in o if r.offer_id[0] < "4" and sizes[r.product_id] > 1}
    got = more.sibling_offers(spark, sf).groupBy("decision_offer").count()
    assert {r.decision_offer: r["count"] for r in got.collect()} == want and {k[1] for k in want} == set("0123456789abcdef")
    assert more.rows_for_ids(spark, sf).filter("l_orderkey % 50 <> 0").count() > 0


def test_phrased_titles_of_any_length(spark):
    from offerloom.operators import corpus

    titles = ["red wine", "old red wine glass", "red wine glass", "wine", "", "glass of red wine and red wine"]
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    phrases = spark.createDataFrame([("red", "wine", 2), ("wine", "glass", 3), *((f"a{i}", "b", 1) for i in range(500))], "first string, second string, n long")
    got = {r.title: r.phrased for r in corpus.phrased(rows, phrases).collect()}
    assert got == dict(zip(titles, ["red_wine", "old red_wine_glass", "red_wine_glass", "wine", "", "glass of red_wine and red_wine"]))


def test_collocation_corpus_rewrites_titles_of_all_lengths(spark):
    from offerloom.plans import more

    rows = more.collocation_corpus(spark, "/root/testdata/sf0.001")
    hits = rows.filter("title <> phrased").select(F.size(F.split("title", " ")).alias("n")).distinct().collect()
    assert {r.n for r in hits} - {3}
    assert rows.filter("replace(phrased, '_', ' ') <> title").count() == 0


def test_phrases_stay_off_the_driver(spark, monkeypatch):
    from offerloom.plans import more

    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: pytest.fail("collected"))
    more.phrase_corpus(spark, "/root/testdata/sf0.001")


def test_document_vectors_are_means(spark, tmp_path, monkeypatch):
    from offerloom.operators import models
    from offerloom.plans import logs

    texts = {1: "größe rot größe", 2: "rot selten", 3: "", 4: None} | {k: "größe rot" for k in range(5, 30)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept, fit = [], models.word_vectors
    monkeypatch.setattr(models, "word_vectors", lambda *a, **b: kept.append(fit(*a, **b)) or kept[0])
    got = {r.doc_id: r.vector for r in logs.word_vectors(spark, str(tmp_path)).collect()}
    v = {r.word: list(r.vector) for r in kept[0].getVectors().collect()}
    assert set(v) == {"größe", "rot"} and set(got) == set(texts)
    for k, t in texts.items():
        words = (t or "").split()
        want = [sum(v[w][i] for w in words if w in v) / max(1, len(words)) for i in range(16)]
        assert got[k] == pytest.approx(want, abs=1e-6)


def test_document_stems_take_the_longest_suffix(spark, tmp_path):
    from offerloom.plans import logs

    spark.createDataFrame([(1, "Kuřatech městech, novými NOVÝCH mestech hradech"), (2, "atech ech žena mužovi")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.token: r.stem for r in logs.document_stems(spark, str(tmp_path)).collect()}
    assert got == {"kuřatech": "kuř", "městech": "měst", "novými": "nov", "nových": "nov", "mestech": "mest", "hradech": "hrad", "atech": "atech", "ech": "ech", "žena": "žen", "mužovi": "muž"}


def test_nearest_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    v = [[rng.random() for _ in range(4)] for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(v)), "vector_id int, embedding array<double>")
    got = {}
    for r in candidates.nearest(df.filter("vector_id < 7").withColumnRenamed("vector_id", "query_id"), df, 5).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append(r.vector_id)
    assert got == {q: sorted(range(60), key=lambda k: (sum((a - b) ** 2 for a, b in zip(v[q], v[k])), k))[:5] for q in range(7)}


def test_updates_and_splits(spark):
    new, old = (spark.createDataFrame(r, "id int, v string") for r in ([(1, "new")], [(1, "old"), (2, "old")]))
    assert sorted(map(tuple, dataset.updated(new, old, ["id"]).collect())) == [(1, "new"), (2, "old")]
    assert sorted(map(tuple, dataset.by_precedence([old, new], "id").collect())) == [(1, "new"), (2, "old")]
    tiny = spark.createDataFrame([(0,), (1,)], "label int")
    assert sorted(r["count"] for r in dataset.augmented(tiny).groupBy("label").count().collect()) == [3, 3]
    snapshots = spark.createDataFrame([("a", 0), ("a", 3)], "category string, version int")
    assert {tuple(r) for r in dataset.next_versions(snapshots, spark.createDataFrame([("a",), ("b",)], "category string")).collect()} == {("a", 4), ("b", 0)}


def test_rate_confidence(spark):
    df = spark.createDataFrame([(0, 0, 0.3), (10, 10, 0.5), (0, 10, 0.5), (5, 10, 0.0), (5, 10, 1.0)], "s long, n long, p double")
    got = [r.c for r in df.select(evaluation.rate_confidence("s", "n", "p").alias("c")).collect()]
    assert got == pytest.approx([0.7, 1 - 0.5**11, 0.5**11, 1.0, 0.0])


def test_catalogue_files(spark, tmp_path):
    (tmp_path / "offers").mkdir()
    (tmp_path / "offers" / "product.42.txt").write_text('{"id": 7, "name": "x", "price": 1.5}\nnot json\n{"id": 8}\n')
    rows = catalog.read_offers(spark, str(tmp_path / "offers")).cache()
    assert sorted((r.id, r.product_id) for r in rows.collect()) == [(7, 42), (8, 42)]
    checked = catalog.validated(rows.withColumn("n", F.lit("x1")), ["id", "price"], {"n": "int"})
    assert {r.id: (r.is_valid, r.invalid_reason) for r in checked.collect()} == {7: (False, "n is not int"), 8: (False, "price is missing")}


def test_stream_retries_and_uniqueness(spark, tmp_path):
    failed = spark.createDataFrame([(1, 1, "2024-01-01 10:00:00"), (2, 5, "2024-01-01 10:00:00"), (3, 1, "2024-01-01 00:00:00")], "offer_id int, tries int, t string").withColumn("first_seen", F.to_timestamp("t"))
    assert [(r.offer_id, r.tries) for r in streaming.retries(failed, now="2024-01-01 11:00:00").collect()] == [(1, 2)]
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (1, "2024-01-01 11:00:00"), (2, "2024-01-01 10:00:00")], "offer_id int, t string").select("offer_id", F.to_timestamp("t").alias("ts"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    once = streaming.once_each(streaming.read_stream(spark, str(tmp_path / "in"), rows.schema))
    streaming.run_batches(once.withColumn("topic", F.lit("t")), lambda b: b, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.offer_id for r in spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out/batch=*")).collect()) == [1, 2]


def test_special_functions():
    from math import comb, erfc, sqrt

    import numpy as np

    from offerloom.functions import special

    t = np.array([0.0, 1e-9, 0.01, 0.5, 1.0, 3.84, 12.0, 12.6, 40.0, 300.0])
    assert np.allclose(special.chi2_one_tail(t), [erfc(sqrt(x / 2)) for x in t], rtol=1e-9, atol=1e-15)
    cases = [(s, n, p) for n in (0, 1, 5, 40) for s in range(0, n + 1, max(1, n // 5)) for p in (0.0, 0.01, 0.3, 0.5, 0.97, 1.0)]
    want = [1.0 if p <= 0 else sum(comb(n + 1, k) * p**k * (1 - p) ** (n + 1 - k) for k in range(s + 1)) if p < 1 else 0.0 for s, n, p in cases]
    s, n, p = (np.array(x, float) for x in zip(*cases))
    assert np.allclose(special.beta_tail(s + 1, n - s + 1, p), want, rtol=1e-9, atol=1e-12)
    # a billion matches need no more memory than one
    many = special.beta_tail(np.array([9e8 + 1]), np.array([1e8 + 1]), np.array([0.9]))
    assert abs(many[0] - 0.5) < 1e-3


def test_prices_far_from_zero(spark):
    from pyspark.sql import functions as F

    from offerloom.operators import features

    prices = [1e8 + d for d in (0.0, 0.01, 0.02, 0.03, 0.04)]
    df = spark.createDataFrame([(k, 1, p) for k, p in enumerate(prices)] + [(9, 1, None), (10, 2, 5.0)], "offer_id long, product_id long, price double")
    got = {r.offer_id: r for r in features.leave_one_out_prices(df).collect()}
    for k in range(5):
        others = [p for j, p in enumerate(prices) if j != k]
        mean = sum(p - 1e8 for p in others) / 4
        m2 = sum((p - 1e8 - mean) ** 2 for p in others)
        assert got[k].others_n == 4 and abs(got[k].others_mean - 1e8 - mean) < 1e-6 and abs(got[k].others_m2 - m2) < 1e-6 * 1e-1
        assert got[k].others_low == min(others) and got[k].others_high == max(others)
    assert got[9].others_n == 5 and got[9].others_low == prices[0] and got[10].others_n == 0 and got[10].others_mean is None


def test_relevant_against_counting(spark):
    """Ties, repeated and null ids, a null and an empty list of words, and blocks of one query and one text."""
    from math import log

    from offerloom.operators import candidates, relevance

    queries = [(1, ["a", "b", "a"]), (2, ["b", "zz"]), (None, ["c"]), (3, None), (4, [])]
    texts = [(10, ["a", "b"]), (11, ["a", "b"]), (11, ["c"]), (12, ["b"] * 40), (13, None), (14, []), (None, ["a", "c", "c"]), (15, ["a", "b"])]
    n, mean = len(texts), sum(len(w or []) for _, w in texts) / len(texts)
    df = {w: sum(w in (words or []) for _, words in texts) for w in "abc"}

    def score(asked, words):
        weigh = lambda tf: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        return round(sum(log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * weigh(words.count(w)) for w in set(asked) if w in words), 9)

    want = set()
    for name, asked in queries:
        scored = sorted((-score(asked or [], words or []), -1 if at is None else at) for at, words in texts)
        want |= {(name, None if at < 0 else at, -s, i + 1) for i, (s, at) in enumerate(x for x in scored[:3] if x[0] < 0)}
    q, t = spark.createDataFrame(queries, "query_id long, words array<string>"), spark.createDataFrame(texts, "text_id long, words array<string>")
    limits = candidates.QUERY_WORDS, candidates.TEXT_WORDS
    try:
        for candidates.QUERY_WORDS, candidates.TEXT_WORDS in (limits, (1, 4)):
            got = {(r.query_id, r.text_id, round(r.relevance, 9), r.place) for r in candidates.relevant(q, t, 3).collect()}
            assert got == want
        assert {(r.query_id, r.text_id, round(r.relevance, 9), r.place) for r in relevance.most_relevant(q, t, 3).collect()} == want
    finally:
        candidates.QUERY_WORDS, candidates.TEXT_WORDS = limits
    for f in (candidates.relevant, relevance.most_relevant):
        assert f(q.limit(0), t, 3).count() == f(q, t.limit(0), 3).count() == 0


@pytest.mark.parametrize("sent, seeds, block", [(1 << 20, 256, 1024), (0, 4, 3)])
def test_most_relevant_leaves_out(spark, monkeypatch, sent, seeds, block):
    """The same texts as when every text is held against every query, from few of the pairs; with words of all frequencies."""
    import random

    from offerloom.operators import candidates, relevance

    for name, value in (("MOST_SENT", sent), ("SEEDS", seeds), ("BLOCK", block)):
        monkeypatch.setattr(relevance, name, value)
    rng = random.Random(8)
    word = lambda: f"w{int(rng.paretovariate(0.6))}"
    texts = [(i, [word() for _ in range(rng.randint(1, 60))]) for i in range(1500)]
    texts += [(i + 2000, texts[i][1]) for i in range(0, 200, 10)]
    queries = [(i, rng.sample(texts[rng.randrange(1500)][1], 1) + [word() for _ in range(rng.randint(0, 8))]) for i in range(60)]
    q, t = spark.createDataFrame(queries, "query_id long, words array<string>"), spark.createDataFrame(texts, "text_id long, words array<string>")
    steps = relevance.explained(q, t, 4)
    key = lambda rows: sorted((r.query_id, r.text_id, round(r.relevance, 8), r.place) for r in rows)
    assert key(steps["result"].collect()) == key(candidates.relevant(q, t, 4).collect())
    assert steps["candidates"].count() < 0.1 * len(texts) * len(queries)


def test_word_vectors_learn_in_parts(spark, monkeypatch):
    from offerloom.operators import models

    rows = spark.createDataFrame([(k, [f"w{k % 3}", f"w{k % 5}", "every"]) for k in range(25)], "id int, words array<string>")
    assert models.word_vectors(rows, "words", size=2, least=1).getNumPartitions() == 1
    monkeypatch.setattr(models, "TITLES_PER_TASK", 10)
    model = models.word_vectors(rows, "words", size=2, least=1)
    assert model.getNumPartitions() == 3 and {r.word for r in model.getVectors().collect()} == {"every"} | {f"w{k}" for k in range(5)}
    assert models.word_vectors(rows.limit(1), "words", size=2, least=1).getNumPartitions() == 1


def _two_topics(spark, n=1600):
    import random

    rng = random.Random(4)
    return spark.createDataFrame([(k, [f"{'ab'[k % 2]}{rng.randrange(30)}" for _ in range(60)]) for k in range(n)], "id long, words array<string>")


def test_word_vectors_of_tasks_side_by_side_are_the_same_again(spark, monkeypatch):
    from offerloom.operators import models

    monkeypatch.setattr(models, "TITLES_PER_TASK", 100)
    rows = _two_topics(spark)
    once, again = ({r.word: list(r.vector) for r in models.word_vectors(rows, "words", size=8, least=1).getVectors().collect()} for _ in range(2))
    assert len(once) == 60 and once == again


def test_word_vectors_tell_topics_apart(spark, monkeypatch):
    import numpy as np

    from offerloom.operators import models

    monkeypatch.setattr(models, "TITLES_PER_TASK", 500)
    rows = _two_topics(spark)
    model = models.word_vectors(rows, "words", size=8, least=1, rounds=2)
    vectors = {r.word: np.array(r.vector) / np.linalg.norm(r.vector) for r in model.getVectors().collect()}
    of = lambda x, y: np.mean([vectors[v] @ vectors[w] for v in vectors for w in vectors if v < w and {v[0], w[0]} == {x, y}])
    assert min(of("a", "a"), of("b", "b")) > 0.8 > 0.3 > of("a", "b")
    other = spark.createDataFrame([(1, ["a1", "x", None]), (2, []), (3, None)], "id long, words array<string>")
    got = {r.id: r.vector for r in model.transform(other).collect()}
    plain = {r.word: list(r.vector) for r in model.getVectors().filter("word = 'a1'").collect()}
    assert got == {1: pytest.approx([x / 3 for x in plain["a1"]]), 2: [0.0] * 8, 3: [0.0] * 8}
    assert sorted(map(tuple, model.learned().select("id", "vector").collect())) == sorted(map(tuple, model.transform(rows).select("id", "vector").collect()))


def test_no_word_is_met_often_enough_for_a_vector(spark):
    from offerloom.operators import models

    rows = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "id long, words array<string>")
    model = models.word_vectors(rows, "words", size=2, least=5)
    assert model.getVectors().count() == 0 and {r.id: r.vector for r in model.learned().collect()} == {k: [0.0, 0.0] for k in (1, 2, 3)}
    assert models.word_vectors(rows.filter("id > 5"), "words", size=2, least=5).learned().count() == 0


def test_slopes_of_word_pairs_are_those_of_their_likelihood():
    import numpy as np

    from offerloom.operators import skipgram

    rng = np.random.default_rng(2)
    n, window, text = 5, 3, np.array([0, 0, 0, 1, 1, 1, 1, 1])
    v, noise = rng.normal(size=(2, len(text), 4)), rng.normal(size=(6, 4))

    def likelihood(v, noise):
        like = lambda x: -np.log1p(np.exp(-x))
        pairs = [(a, b, (window + 1 - (b - a)) / window) for a in range(n) for b in range(a + 1, min(a + window, len(text) - 1) + 1) if text[a] == text[b]]
        return sum(w * (like(v[0, x] @ v[1, y]) + skipgram.NOISE / len(noise) * like(-(noise @ v[0, x])).sum()) for a, b, w in pairs for x, y in ((a, b), (b, a)))

    got = skipgram._slopes(v, noise, text, n, window)
    for at in np.ndindex(v.shape):
        moved = v.copy()
        moved[at] += 1e-5
        assert got[at] == pytest.approx((likelihood(moved, noise) - likelihood(v, noise)) / 1e-5, abs=1e-3)
    for at in np.ndindex(noise.shape):
        moved = noise.copy()
        moved[at] += 1e-5
        assert got[1, len(text) + at[0], at[1]] == pytest.approx((likelihood(v, moved) - likelihood(v, noise)) / 1e-5, abs=1e-3)
