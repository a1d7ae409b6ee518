"""Operators on one text at a time, against plain Python."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from offerloom.llm import grades, packing, pieces, rules, secrets, wordpiece

PIECES = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


# --- secrets ---


def plain_spans(text):
    out = []
    for n, (kind, pattern, keep) in enumerate([
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]):
        out += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if keep(m)]
    return [s for *_, s in sorted(out)]


def test_secrets(spark, docs, edge):
    rng = random.Random(3)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", ' "', "'", "abcdefghijkl", "short", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", " ", "\n", "é😀", "="]
    made = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(400)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string")).unionByName(edge.select("doc_id", "text"))
    want = sorted((str(r.doc_id), *[sum(s.startswith(k) for s in plain_spans(r.text or "")) for k in ("assign:", "access:", "hex:")], hashlib.sha256(",".join(plain_spans(r.text or "")).encode()).hexdigest()) for r in df.collect())
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan(df).collect())
    assert got == want and any(w[1] for w in want) and any(w[2] for w in want)


def test_added_secrets_and_queries(spark):
    df = spark.createDataFrame([(1, "x ghp_" + "a1" * 20 + " -----BEGIN RSA PRIVATE KEY-----")], "doc_id long, text string")
    spans = secrets.scan(df).first().spans
    assert "git_token:2:46" in spans and "private_key:47:78" in spans
    assert secrets.trigram_query("[0-9a-f]{16,}") is None and secrets.trigram_query("AKIA[A-Z]+") == [frozenset({"aki", "kia"})]
    assert secrets.trigram_query("(abcd|xyz)q?") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]


def test_queries_of_all_rules():
    """Small classes are alternatives; only hex is looked for in every text."""
    queries = {r.kind: secrets.trigram_query(r.regex) for r in secrets.RULES}
    sets = lambda *words: sorted((frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words), key=sorted)
    assert [k for k, q in queries.items() if q is None] == ["hex"]
    assert queries["git_token"] == sets("ghp_", "gho_", "ghu_", "ghs_", "ghr_") and queries["chat_token"] == sets("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")
    assert queries["access"] == sets("akia") and queries["cloud_key"] == sets("aiza") and queries["pay_key"] == sets("sk_live_", "rk_live_")
    assert queries["web_token"] == [frozenset({"eyj", ".ey"})] and {"-----begin "[:3], "beg", "key", "ey-"} <= queries["private_key"][0]
    assert secrets.trigram_query("x[^ab]yz") is None and secrets.trigram_query("a[0-9]bcd") == [frozenset({"bcd"})] and secrets.trigram_query("a[x-z]c") == sets("axc", "ayc", "azc")


def test_postings_for_other_rules(spark, docs):
    """Written once, read for another rule set; rules that need other trigrams are an error."""
    made = spark.createDataFrame([(9001, "xoxb-" + "1a" * 8), (9002, "AKIA" + "Q" * 20), (9003, None), (None, "xoxp-" + "2b" * 8)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(made)
    held = secrets.index(df)
    other = tuple(r for r in secrets.RULES if r.kind in ("access", "chat_token"))
    key = lambda rows: sorted((str(r.doc_id), r.spans) for r in rows)
    got = key(secrets.scan(df, other, held=held).collect())
    assert got == key(secrets.scan(df, other).collect()) and sum(bool(s) for _, s in got) >= 3
    with pytest.raises(ValueError):
        secrets.scan(df, (secrets.SecretRule("new", "qqq[0-9]+"),), held=held)


def test_secrets_empty(empty):
    assert secrets.scan(empty).count() == 0


# --- token counts ---


def greedy(word, first, later):
    n, at = 0, 0
    while at < len(word):
        vocabulary = first if at == 0 else later
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_longest_match():
    rng = random.Random(5)
    for _ in range(300):
        make = lambda k: {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(k)}
        first, later = make(6), make(8)
        automaton = wordpiece.LongestMatch(first, later)
        for _ in range(40):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, first, later), (word, first, later)


def test_token_counts(docs, edge, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    first, later = {p[1:] for p in vocabulary if p[0] == "▁"} - {""}, {p for p in vocabulary if "▁" not in p}
    df = docs.select("doc_id", "text").limit(20).unionByName(edge.select("doc_id", "text"))
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown) for r in wordpiece.count_tokens(df, PIECES).collect())
    want = []
    for r in df.collect():
        each = [greedy(w, first, later) for w in re.split(r"[ \t-\r]+", r.text or "") if w]
        want.append((str(r.doc_id), len(each), sum(1 if n < 0 else n for n in each), each.count(-1)))
    assert got == sorted(want) and wordpiece.count_tokens(empty, PIECES).count() == 0


# --- pieces ---


def test_pieces(spark, docs, edge, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(1)
    made = [(k, "".join(rng.choice("ab ▁\n\t é日😀<s>0x1.,'") for _ in range(rng.randint(0, 120)))) for k in range(300)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string")).unionByName(edge.select("doc_id", "text"))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in df.collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((str(r.doc_id), len(ids), digest(b"".join(i.to_bytes(4, "little") for i in ids)), digest(sp.decode(ids).encode())))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encode_and_decode(df, PIECES).collect()]
    assert sorted(got) == sorted(want) and pieces.encode_and_decode(empty, PIECES).count() == 0


def test_every_new_cut_is_compared_once():
    model = pieces.PieceModel(PIECES)
    for text in ("x" * 500, "y" * 300 + "\n" + "z" * 250, "a  b\n\n c é", "日本\n" + " " * 5, "▁ \n"):
        assert model.encode(text) == model.library.encode(text) and model.new
        assert model.differences() == 0 and not model.new
    model.cuts("word\nnew"), model.new.append(("odd", b"\0\0\0\0", "odd"))
    assert model.differences() == 1


def test_long_words_use_the_heap():
    model = pieces._model(PIECES)
    for word in ("abcde" * 60, "x" * 500, "日" * 100):
        assert model.encode(word) == model.library.encode(word)


# --- packing ---


def test_pack_documents(docs, edge, empty):
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    df = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text").filter("doc_id is not null and doc_id > 2"))
    ids = {r.doc_id + (0 if k < 200 else 10**6): [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for k, r in enumerate(df.collect())}
    df = df.collect()
    df = docs.sparkSession.createDataFrame([(r.doc_id + (0 if k < 200 else 10**6), r.text) for k, r in enumerate(df)], "doc_id long, text string")
    # null and repeated ids: the pieces' lengths and hashes are those of all their texts
    some = edge.select("doc_id", "text").filter("doc_id is null or doc_id <= 2")
    pieces_of = packing.pack_documents(some.coalesce(1), JSON).collect()
    texts = [(r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in some.collect()]
    assert sum(r.length for r in pieces_of) == sum(len(t) for _, t in texts)
    assert sorted((str(r.doc_id), r.doc_tokens) for r in pieces_of if r.start == 0) == sorted((str(i), len(t)) for i, t in texts)
    out = packing.pack_documents(df, JSON).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for doc, rows in by_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[doc][at : at + r.length]))
            at += r.length
        assert at == len(ids[doc])
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0 and len(rows) <= 64
    assert packing.pack_documents(empty, JSON).count() == 0


def test_words_of_letters_skip_the_pattern(docs):
    """Ids are the library's as a whole; only words that aren't letters and marks go through its pattern."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    whole = lambda text: b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids)
    rng = random.Random(5)
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x410, 0x450)) if c not in (0xD7, 0xF7)]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) + rng.choice(("", ",", "...", "?!:;", "$$$", ")_-]", "~<`|^", ".'", "'")) for _ in range(3000)] + letters
    words += ["don't", "it's,", "'s", "l'eau", "x1", "a×b", "ªº", "a.b", ".", "日本", "x" * 300, "é" * 300 + "."]
    words += [w for r in docs.select("text").limit(50).collect() for w in (r.text or "").split()]
    tokenizer = packing.ByteTokenizer(JSON)
    for w in words:
        assert tokenizer.spaced[w] == whole(" " + w) and tokenizer.bare[w] == whole(w)
        assert tokenizer.encode(f"{w} {w}\n{w}") == whole(f"{w} {w}\n{w}")
    asked, tokenizer = [], packing.ByteTokenizer(JSON)
    tokenizer.whole = lambda text: asked.append(text) or whole(text)
    tokenizer.encode("Some words, été. Слово! x1 x1")
    assert sorted(asked) == [" x1", "!", ",", "."]


def test_recent_words_stay():
    """What is used between two changes of the memo is never made again."""
    made = []
    memo = packing.Recent(lambda w: made.append(w) or len(w), limit=3)
    for k in range(40):
        assert memo["often"] == 5 and memo[str(k)] == len(str(k))
        memo.trim()
    assert made.count("often") == 1 and len(made) == 41 and len(memo) + len(memo.older) <= 9


@pytest.mark.parametrize("limits", [packing.Limits(100, 4, 50), packing.Limits(64, 64, 10)])
def test_pack_examples(spark, limits):
    rng = random.Random(2)
    rows = [(k // 2, None if k == 5 else rng.randint(0, 60), rng.randint(0, 30)) for k in range(3000)] + [(9999, 500, 1)]
    out = packing.pack_examples(spark.createDataFrame(rows, "id long, t int, l int"), ["id"], "t", "l", limits).collect()
    assert sorted((r.id, r.n_tokens, r.n_loss) for r in out) == sorted((a, b or 0, c) for a, b, c in rows)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    beyond = lambda r: r.n_tokens > limits.tokens or r.n_loss > limits.loss
    assert all(r.oversized and beyond(r) for r in sequences.pop(None))
    for s in sequences.values():
        assert sum(r.n_tokens for r in s) <= limits.tokens and len(s) <= limits.segments and sum(r.n_loss for r in s) <= limits.loss
    packed = [r for r in out if not r.oversized]
    assert not any(map(beyond, packed))
    least = max(sum(r.n_tokens for r in packed) / limits.tokens, len(packed) / limits.segments, sum(r.n_loss for r in packed) / limits.loss)
    assert len(sequences) <= 1.25 * least + 8


def test_pack_conversations(spark, sf):
    from collections import Counter

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    turns = spark.read.parquet(f"{sf}/conversations.parquet").unionByName(spark.createDataFrame([(None, None, None, None), (None, 1, "assistant", "ab <|endoftext|>")], "conv_id long, turn int, role string, text string"), allowMissingColumns=True)
    limits = packing.Limits(600, 5, 200)
    tokens, loss = Counter(), Counter()
    for r in turns.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        tokens[r.conv_id] += n
        loss[r.conv_id] += n * (r.role == "assistant")
    out = packing.pack_conversations(turns, JSON, limits).collect()
    assert {r.conv_id: (r.n_tokens, r.n_loss) for r in out} == {k: (tokens[k], loss[k]) for k in tokens} and len(out) == len(tokens)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    fits = lambda s: sum(r.n_tokens for r in s) <= 600 and len(s) <= 5 and sum(r.n_loss for r in s) <= 200
    assert not any(fits([r]) for r in sequences.pop(None, ())) and all(map(fits, sequences.values()))
    # the loss limit binds: without it some sequence of several conversations goes past it
    free = {}
    for r in packing.pack_conversations(turns, JSON, packing.Limits(600, 5, 600)).collect():
        free.setdefault(r.sequence_id, []).append(r.n_loss)
    free.pop(None, None)
    assert any(len(s) > 1 and sum(s) > 200 for s in free.values())


# --- rules ---


def plain_statistics(text):
    space = " \t\n\x0b\x0c\r"
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    lines = [line for line in text.split("\n") if line.strip(space)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + d for v in at.values() if len(v) > 1 for i in v for d in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_statistics(spark, docs, edge, empty):
    made = [(1000 + k, t) for k, t in enumerate(["a b c a b c", "x\nx\n \nx", "a a a a", "#$ %\tb", "a b c d a b c", "\x0ba\x1cb c"])]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string")).unionByName(edge.select("doc_id", "text"))
    want = sorted((str(r.doc_id), *plain_statistics(r.text or "")) for r in df.collect())
    judged = rules.judge(df, [])
    got = judged.collect()
    assert sorted((str(r.doc_id), *(r[c] for c in rules.COUNTS)) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed) for r in got)
    assert rules.judge(empty, []).count() == 0 and rules.judge(edge, []).count() == edge.count()
    names = ("_text", "_words", "_lines", "_windows", "_own_0", "_n_lines", "key")
    clash = edge.select("doc_id", "text", *(F.lit(n).alias(n) for n in names))
    rows = rules.judge(clash, []).collect()
    assert {tuple(r[n] for n in names) for r in rows} == {names} and sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in edge.collect())


def test_decision_list(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    x = rng.random((3000, len(rules.FEATURES)))
    bad = ((x[:, 1] > 0.8) & (x[:, 4] < 0.5)) | (x[:, 2] > 0.9)
    learned = rules.learn_list(x, bad)
    test = rng.random((3000, len(rules.FEATURES)))
    truth = ((test[:, 1] > 0.8) & (test[:, 4] < 0.5)) | (test[:, 2] > 0.9)
    says = np.zeros(len(test), bool)
    for r in learned:
        says |= rules.covers(r, test)
    assert (says == truth).mean() > 0.97
    df = spark.createDataFrame([tuple(map(float, row)) for row in test[:200]], ", ".join(f"{f} double" for f in rules.FEATURES))
    assert [r.k for r in df.select(rules.verdict(learned).alias("k")).collect()] == [not s for s in says[:200]]
    assert rules.learn_list(x[:0], bad[:0]) == [] and spark.range(1).select(rules.verdict([]).alias("k")).first().k


def test_rules_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    learned = rules.learn(d, labels.filter("doc_id % 2 = 0"))
    rows = rules.judge(d, learned).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality > 0) for r in rows) / len(rows) > 0.97


# --- grades ---


def test_grades_on_held_out(spark, edge, empty):
    sf = "/root/testdata/sf0.1"
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = grades.train(d, labels.filter("doc_id % 2 = 0"))
    assert model.thresholds[0] < model.thresholds[1]
    rows = grades.score(d, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", "toxic", "selected", "expected_grade").collect()
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(r.selected == (r.quality == 1 and r.toxic == 0) for r in rows) / len(rows) > 0.95
    assert sum(r.selected for r in clean) / len(clean) > 0.99
    mean = lambda rs: sum(r.expected_grade for r in rs) / len(rs)
    assert mean([r for r in rows if r.toxic]) < mean([r for r in rows if not r.toxic and r.quality == 0]) < mean(clean)
    out = grades.score(edge, model)
    assert out.count() == edge.count() and set(edge.columns) < set(out.columns) and grades.score(empty, model).count() == 0
    clash = edge.selectExpr("'x' as selected", "1 as expected_grade", "doc_id", "text", "kept")
    assert sorted((str(r.doc_id), r.expected_grade) for r in grades.score(clash, model).collect()) == sorted((str(r.doc_id), r.expected_grade) for r in out.collect())
    assert grades.train(d, labels.limit(0)).weights == {}


def test_ordinal_fit():
    import numpy as np

    rng = np.random.default_rng(7)
    rows = []
    for _ in range(800):
        words = rng.integers(0, 40, 12)
        s = sum(1 if w < 10 else -1 if w > 30 else 0 for w in words) + rng.logistic() * 0.3
        rows.append((words.astype(np.int32), np.ones(12), int(s > -1) + int(s > 2)))
    model = grades.fit(rows[:600], least_z=2.0)
    scores = np.array([sum(model.weights.get(int(w), 0) for w in r[0]) for r in rows[600:]])
    tails = model.tails(scores)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == [r[2] for r in rows[600:]]).mean() > 0.8
