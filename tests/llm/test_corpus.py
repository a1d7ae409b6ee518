"""Operators that bring documents together, against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offerloom.llm import imatch, nearjoin, pii, warc


def shingle_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_join(rows):
    """Links of distinct sets and smallest ids of components, by all pairs."""
    sets = sorted({shingle_set(t) for _, t in rows} - {frozenset()}, key=sorted)
    root, links = list(range(len(sets))), Counter()

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            if (n := len(sets[a] & sets[b])) and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i, t in rows:
        if (s := shingle_set(t)) and i is not None:
            k = top(sets.index(s))
            least[k] = min(i, least.get(k, i))
    out = []
    for i, t in rows:
        s = shingle_set(t)
        out.append((str(i), str(least.get(top(sets.index(s))) if s else i), links[sets.index(s)] if s else 0))
    return sorted(out)


def near_rows():
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base[:20 + k] + [f"x{k}"] + base[21 + k:])) for k in range(40)]  # each one word away from the next
    rows += [(100 + k, " ".join(base)) for k in range(5)] + [(200, " ".join(base[:90])), (201, " ".join(f"y{k}" for k in range(50))), (202, "a b c"), (203, "a b c"), (204, "a b d")]
    return rows + [(None, " ".join(base)), (None, " ".join(f"z{k}" for k in range(30)))]


def test_near_join(spark, edge, empty, docs):
    for df in (spark.createDataFrame(near_rows(), "doc_id long, text string"), edge, docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in nearjoin.join_near(df).collect())
        assert got == plain_join(rows)
    assert nearjoin.join_near(empty).count() == 0


def test_blocks_agree_with_one_block(spark, monkeypatch):
    monkeypatch.setattr(nearjoin, "LEAST_BLOCK", 8)
    df = spark.createDataFrame(near_rows(), "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in nearjoin.join_near(df).collect()) == plain_join(near_rows())


@pytest.mark.parametrize("block", [4, 8])
def test_chains_are_compared_by_bucket(spark, monkeypatch, block):
    """A long chain of neighbours: its buckets hold fewer pairs than the chain, and no link is counted twice."""
    monkeypatch.setattr(nearjoin, "LEAST_BLOCK", block)
    monkeypatch.setattr(nearjoin, "MOST_BLOCK", block)
    rows = [(i, " ".join(f"w{k}" for k in range(i * step, i * step + 80))) for i, step in ((i, 6 + i % 3) for i in range(150))]
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in nearjoin.join_near(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_join(rows) and any(r[2] for r in got)


def test_one_rule_at_every_size(spark, monkeypatch):
    """A thousand planted links at all similarities from 0.8 on: the same links, whether groups or buckets are compared."""
    import random

    rng, rows = random.Random(12), []
    for group in range(110):
        words = [f"g{group}w{k}" for k in range(100)]
        for copy in range(7):
            changed = list(words)
            for k in rng.sample(range(0, 100, 9), rng.randint(0, 2)):
                changed[k] = f"g{group}c{copy}x{k}"
            rows.append((group * 10 + copy, " ".join(changed)))
    df, want = spark.createDataFrame(rows, "doc_id long, text string"), plain_join(rows)
    assert sum(n for *_, n in want) // 2 >= 1000
    for block, parts in ((4096, 16), (2, 2)):
        for name, value in (("LEAST_BLOCK", block), ("MOST_BLOCK", block), ("PARTS", parts)):
            monkeypatch.setattr(nearjoin, name, value)
        assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in nearjoin.join_near(df).collect()) == want


def test_pairs_without_a_common_band_are_no_links():
    import numpy as np

    a = [np.arange(100, dtype=np.uint64)] * 2
    signatures = np.stack([np.zeros(nearjoin.VALUES, np.uint32), np.zeros(nearjoin.VALUES, np.uint32)])
    signatures[1, :: nearjoin.BAND_VALUES] = 1  # four of five values of each band agree
    assert len(nearjoin.likely_pairs(signatures, signatures, True, 0.8)[0]) == 1
    assert len(nearjoin.linked(a, a, signatures, signatures, True, 0.8)[0]) == 0
    signatures[1, 10] = 0
    assert len(nearjoin.linked(a, a, signatures, signatures, True, 0.8)[0]) == len(nearjoin.linked(a, a, signatures, signatures, True, 0.8, 2)[0]) == 1
    assert len(nearjoin.linked(a, a, signatures, signatures, True, 0.8, 3)[0]) == 0  # told in band 2


def test_parted(spark):
    from offerloom.llm.common import parted

    rows = spark.range(3000).selectExpr("id", "if(id % 10 = 0, null, id) as _place0", "id as _set0")
    none, others = parted(rows, F.xxhash64("_place0"), spark.range(0, 3000, 7).select(F.xxhash64("id").alias("h")))
    assert none.columns == rows.columns and none.filter("_place0 % 7 = 0").count() == 0 and none.count() + others.count() == 3000 and others.count() < 1200


def test_overlaps_by_matrix():
    import numpy as np

    rng = np.random.default_rng(1)
    a = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    b = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    i, j = (x.ravel() for x in np.meshgrid(range(30), range(30), indexing="ij"))
    assert (nearjoin.overlaps(a, b, i, j) == [len(set(a[x]) & set(b[y])) for x, y in zip(i, j)]).all()
    assert (nearjoin.overlaps(a, a, i, j) == [len(set(a[x]) & set(a[y])) for x, y in zip(i, j)]).all()


def test_pruning_keeps_similar_pairs():
    needed = nearjoin.matches_needed(0.8)
    assert needed[16] <= 6 and needed[nearjoin.VALUES] < 0.8 * nearjoin.VALUES
    assert all(a <= b for a, b in zip(needed, needed[1:]))


def test_texts_of_a_repeated_id_are_judged_by_themselves(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    near = words(1).rsplit(" ", 1)[0] + " other"
    rows = [(1, words(1)), (5, near), (5, words(2)), (5, words(3)), (5, words(3)), (6, words(4)), (6, words(4).rsplit(" ", 1)[0] + " end"), (7, words(2)), (8, ""), (8, "!"), (9, words(5))]
    got = sorted((r.doc_id, r.text) for r in nearjoin.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    six = [t for i, t in got if i == 6]
    assert len(six) == 1 and (6, six[0]) in rows
    assert [x for x in got if x[0] != 6] == sorted([(1, words(1)), (5, words(2)), (5, words(3)), (8, ""), (8, "!"), (9, words(5))])


def test_one_of_each(spark, edge, empty):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in near_rows()], "doc_id long, text string, _set_key string, _only string, _set_key0 string")
    got = nearjoin.one_of_each(df)
    assert got.columns == df.columns and {tuple(r)[2:] for r in got.collect()} == {("x", "y", "z")}
    classes = {(a, b) for a, b, _ in plain_join(near_rows())}
    assert {str(r.doc_id) for r in got.collect() if r.doc_id is not None} == {a for a, b in classes if a == b and a != "None"}
    assert sum(r.doc_id is None for r in got.collect()) == 1
    kept = [(r.doc_id, r.text) for r in nearjoin.one_of_each(edge).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [1, 3, 4, 5, 6, 7, 8]
    assert nearjoin.one_of_each(empty).count() == 0


# --- fingerprints ---


def test_fingerprints(spark, docs, edge, empty):
    for df in (docs, edge):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for k, (i, t) in enumerate(rows):
            cut, after = len(t) // 4, rows[(k + 1) % len(rows)][1]
            want.append((str(i), len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
        got = imatch.fingerprints(df).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {}
    for r in imatch.fingerprints(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        prints.setdefault(r.text, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    got = imatch.fingerprints(docs).agg(F.avg("near_edited").alias("a"), F.avg("near_next").alias("b")).first()
    assert got.a > 0.3 and got.b < 0.05
    assert imatch.fingerprints(empty).count() == 0


def plain_imatch(texts, band):
    """For each text the term sets that its subsets leave, and whether a bitmap without false hits would tell the same."""
    import math

    import xxhash

    terms = [set(re.findall(r"[^\W_]+", t.lower())) for t in texts]
    df = Counter(w for ts in terms for w in ts)
    hashed = {w: xxhash.xxh64_intdigest(w.encode(), seed=42) for w in df}
    inside = {w for w, n in df.items() if band.least_idf <= math.log(len(texts) / n) <= band.most_idf}
    out = []
    for ts in terms:
        kept = ts & inside or ts
        picks = [frozenset(kept)]
        for rate in band.rates:
            for copy in range(band.copies):
                picks.append(frozenset(w for w in kept if (hashed[w] >> 7 * copy) & ((1 << rate) - 1) == 0))
        out.append(picks)
    return out, inside, hashed


def test_fingerprints_by_brute_force(spark, docs, monkeypatch):
    """Subsets' hashes are equal where the sets of terms are, over the texts and their edited forms."""
    monkeypatch.setattr(imatch, "_BITS_EACH", 1 << 16)  # no false hits
    band = imatch.Band(0.5, 4.0)
    df = docs.select("doc_id", F.translate("text", "_", " ").alias("text"))
    rows = sorted((r.doc_id, r.text or "") for r in df.collect())
    got = {r.doc_id: r for r in imatch.fingerprints(df, band).collect()}
    picks, inside, _ = plain_imatch([t for _, t in rows], band)
    lexicon = imatch.lexicon_of(df, F.col("text"), band)
    assert sum(bin(b).count("1") for b in lexicon.bits) == len(inside)
    by_set, by_hash = {}, {}
    for (i, _), sets in zip(rows, picks):
        hashes = got[i].fingerprint.split(",")
        assert len(hashes) == len(sets) == 1 + band.copies * len(band.rates)
        for h, s in zip(hashes, sets):
            assert (h == "-") == (not s)
            assert by_set.setdefault(s, h) == h and by_hash.setdefault(h, s) == s
    # likeness, from the sets
    def like(a, b):
        if a == b:
            return 1.0
        shares = []
        for start, n in [(0, 1), *((1 + k * band.copies, band.copies) for k in range(len(band.rates)))]:
            told = [(x, y) for x, y in zip(a[start : start + n], b[start : start + n]) if x or y]
            shares.append(sum(x == y for x, y in told) / max(4, len(told)))
        return max(shares)

    for k, (i, _) in enumerate(rows):
        assert abs(got[i].near_next - like(picks[k], picks[(k + 1) % len(rows)])) < 1e-9


def test_next_over_gaps(spark):
    ids = [-5, 0, 1, 2, 10**6, 10**6 + 1, 2**40, 2**40 + 7]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    for per_range in (1, 2, 3, 100):
        got = {r.doc_id: r.next_text for r in imatch.with_next(df, "doc_id", ["doc_id", "text"], lambda x: x, ["text"], per_range).collect()}
        assert got == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_ranges_hold_equal_numbers(spark):
    """One far id doesn't put all others into one range."""
    df = spark.range(2000).union(spark.sql("select 1000000000000 as id"))
    ends = imatch.range_ends(df, "id", 100)
    assert len(ends) == 19 and all(80 <= b - a <= 120 for a, b in zip(ends, ends[1:]))


# --- surrogates ---


def luhn(digits):
    return sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(int(c) for c in digits[-2::-1])) % 10


def test_surrogates(spark, edge, empty):
    texts = [
        "mail jane.doe9@mail5.example.com or +1 (743) 555-3824, card 4111 1111 1111 1111.",
        "again JANE.DOE9@MAIL5.EXAMPLE.COM and jane.doe9@mail5.example.com, 10.20.30.40; 4111111111111111",
        "Mrs Anna Novak met Mr Novak; ssn 123-45-6789, iban DE89370400440532013000. Госпожа Иванова",
        "clean text 12 345 and 3.14 and 1.2.3 and v2.0 a@b",
        "Mr. Novak and Mr Novak. Later Novak left, and so did Anna; Novakova stayed",
        "Mr Novak, in another text than Anna. Κυρία Μαρία Παππά; info@пример.рф, 电邮@例子.中国, +420 603 111 222, +420603111222",
    ]
    df = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in pii.replace(df, "k").collect()}
    assert out[3].text == texts[3] and out[3].n_entities == 0 and out[3].n_chars == 7
    assert [out[k].n_entities for k in range(6)] == [3, 4, 5, 0, 2, 6] and all(out[k].n_chars == len(out[k].text) for k in (0, 1, 2, 4, 5))
    whole = " ".join(out[k].text for k in range(3))
    for secret in ("jane.doe9", "JANE.DOE9", "555-3824", "4111 1111 1111 1111", "4111111111111111", "10.20.30.40", "123-45-6789", "DE893704", "Novak", "Иванова"):
        assert secret not in whole
    first = re.search(r"mail (\S+@\S+) or (\+1 \(\d{3}\) \d{3}-\d{4}), card (\d{4} \d{4} \d{4} \d{4})\.", out[0].text)
    second = re.search(r"again (\S+@\S+) and (\S+@\S+), (\d+\.\d+\.\d+\.\d+); (\d{16})", out[1].text)
    assert first[1] == second[2] and first[1].upper() == second[1] and first[3].replace(" ", "") == second[4]
    assert (luhn(second[4]) + int(second[4][-1])) % 10 == 0
    third = re.search(r"Mrs (\w+lina) (\w+) met Mr (\w+); ssn 9\d\d-\d\d-\d{4}, iban (DE\d{20})\. Госпожа [а-яА-Я]+$", out[2].text)
    assert third and third[2] == third[3]
    assert int("".join(str(int(c, 36)) for c in third[4][4:] + third[4][:4])) % 97 == 1
    # all mentions of a name agree, with and without title and dot; other words with the same start stay
    family = third[2]
    assert out[4].text == f"Mr. {family} and Mr {family}. Later {family} left, and so did Anna; Novakova stayed"
    fifth = re.fullmatch(rf"Mr {family}, in another text than Anna\. Κυρία [α-ωΑ-Ω]+λινα [α-ωΑ-Ω]+; ([a-z]+)@([а-я]+)\.example, [\u4e00-\u4eff]+@[\u4e00-\u4eff]+\.example, (\+420 \d{{3}} \d{{3}} \d{{3}}), (\+420\d{{9}})", out[5].text)
    assert fifth and fifth[3].replace(" ", "") == fifth[4] and fifth[4] != "+420603111222"
    assert {r.doc_id: r.text for r in pii.replace(df, "other key").collect()}[0] != out[0].text
    assert sorted(str(r.text) for r in pii.replace(edge, "k").collect()) == sorted(str(r.text) for r in edge.collect()) and pii.replace(empty, "k").count() == 0


def test_every_entity_is_likely(spark):
    """The cheap look lets every entity through: made examples of each kind, the shortest among them."""
    import random

    rng = random.Random(13)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    sep = lambda: rng.choice([" ", ".", "-"])
    made = {
        "email": lambda: f"{rng.choice('aé1')}@{rng.choice('bж2')}.{rng.choice(['cz', 'рф'])}",
        "ip": lambda: ".".join(str(rng.choice([0, 1, 9, 10, 255])) for _ in range(4)),
        "phone": lambda: rng.choice(["", "+1", "+420 "]) + rng.choice([f"({digits(3)})", f"{digits(3)}{sep()}"]) + f"{digits(3)}{sep()}{digits(4)}",
        "phone_intl": lambda: "+" + digits(rng.randint(1, 3)) + "".join(rng.choice(["", sep()]) + digits(rng.randint(2, 4)) for _ in range(rng.randint(2, 5))),
        "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "card": lambda: rng.choice(["", " ", "-"]).join([digits(4), digits(4), digits(4), digits(rng.randint(1, 7))]),
        "iban": lambda: "".join(rng.choices("ABXYZ", k=2)) + digits(2) + "".join(rng.choice(["", " "]) + "".join(rng.choices("AB12", k=4)) for _ in range(rng.randint(3, 7))),
        "name": lambda: f"{rng.choice([t for ts in pii.TITLES.values() for t in ts])}{rng.choice(['', '.'])} {rng.choice(['Ab', 'Жд', 'Éa'])}",
    }
    assert set(made) == set(pii.KINDS) == set(pii.NEEDS)
    rows = [(kind, f"x {make()} y") for kind, make in made.items() for _ in range(200)] + [("phone_intl", "call +123456 now")]
    df = spark.createDataFrame(rows, "kind string, text string")
    found = df.filter(F.col("text").rlike(pii.ENTITY))
    assert {r.kind for r in found.select("kind").distinct().collect()} == set(made) and found.filter(~F.col("text").rlike(pii.LIKELY)).count() == 0
    for kind, regex in pii.KINDS.items():
        assert df.filter(F.col("text").rlike(regex) & ~F.col("text").rlike(pii.NEEDS[kind])).count() == 0
    out = pii.replace(spark.createDataFrame([(1, "call +123456 now")], "doc_id long, text string"), "k").first()
    assert out.n_entities == 1 and re.fullmatch(r"call \+1\d{5} now", out.text) and "+123456" not in out.text


def test_domains_stay_different(spark):
    """More domains than short surrogates: two domains never share one, and addresses of one domain stay together."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, f"{user}@{c}.org and {user.upper()}@{c.upper()}.ORG") for k, (c, user) in enumerate((c, u) for c in letters for u in ("me", "you"))]
    out = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    domains = {}
    for k, text in rows:
        first, second = re.fullmatch(r"(\S+@\S+) and (\S+@\S+)", out[k]).groups()
        assert first.upper() == second
        domains.setdefault(text.split("@")[1].split(".")[0], set()).add(first.split("@")[1])
    assert all(len(d) == 1 for d in domains.values()) and len(set.union(*domains.values())) == len(letters)


def test_own_columns_stay(spark):
    """Columns of the caller under the names of working columns."""
    names = ("_handle", "_new", "_bare", "_gaps", "_found", "_own_0", "surface", "kind")
    df = spark.createDataFrame([(1, "mail a@b.cz", *names), (2, None, *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = pii.replace(df, "k")
    assert set(out.columns) == {*df.columns, "n_entities"}
    assert all(tuple(r[n] for n in names) == names for r in out.collect()) and {r.n_entities for r in out.collect()} == {0, 1}


def test_bare_names(spark):
    df = spark.createDataFrame([(1, "Frau Anna Novak sang. Anna and Novak; ANNA, Anna-Maria, xNovak, Novak's (Novak)")], "doc_id long, text string")
    out = pii.replace(df, "k").first().text
    found = re.fullmatch(r"Frau (\w+) (\w+) sang\. (\w+) and (\w+); ANNA, Anna-Maria, xNovak, (\w+)'s \((\w+)\)", out)
    assert found and found[1] == found[3] and found[2] == found[4] == found[5] == found[6], out


def test_surrogates_stay_different(spark):
    """More entities than forms of one length: forms get longer, and nothing clashes."""
    letters = "abcdefghijklmnopqrstuvwxyzéüñö"
    rows = [("email", f"{c}@x.org") for c in letters] + [("ssn", f"{k:02}") for k in range(100)] + [("ssn", "91")] + [("family", "Novak")] + [("phone", f"+1{k}") for k in range(10)]
    forms = pii.surrogates(spark.createDataFrame(rows, "kind string, canon string"), "k").collect()
    assert sorted((r.kind, r.canon) for r in forms) == sorted(set(rows))
    assert len({(r.kind, r.form) for r in forms}) == len(set(rows)) and not {(r.kind, r.form) for r in forms} & set(rows)
    assert all(r.form.startswith("+1") for r in forms if r.kind == "phone")


# --- archives ---


def page_rows():
    long = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60
    return [(1, "http://a", long), (2, "http://b", long), (5, "http://c\r\nX: y", long), (3, None, "short"), (4, "http://d", "short"), (6, "u", None), (7, "u", ""), (8, "u", "only " * 300), (5, "http://c2", long), (None, "u", long), (None, "n", "none " * 300), (None, "n", "none " * 300)]


def test_archives(spark):
    pages = spark.createDataFrame([(*r, 1) for r in page_rows()], "page_id long, url string, html string, payload_digest int")
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.rewritten(pages).collect())
    best = {}
    for i, _, h in page_rows():
        if i is not None:
            best[h] = max(i, best.get(h, i))
    want = []
    for i, _, h in page_rows():
        data = (h or "").encode()
        revisit = len(data) >= 1000 and h in best and i != best[h]
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", str(best[h] if revisit else None)))
    assert got == sorted(want)
    assert warc.rewritten(pages.limit(0)).count() == 0


def read_all(folder):
    import gzip

    return [x for f in folder.glob("part-*") for x in warc.parse(gzip.open(f))]


def test_records(spark, tmp_path, monkeypatch):
    """Record ids are different, revisits refer to a response with their payload, and files are bounded by payload size."""
    monkeypatch.setattr(warc, "FILES", ((2000, 3), (1 << 62, 1)))
    pages = spark.createDataFrame([*page_rows(), (20, "big", "z" * 5000), (21, "big", "y" * 5000)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.resolve(pages), str(tmp_path / "a"))
    records = read_all(tmp_path / "a")
    assert len(records) == pages.count()
    ids = [h["warc-record-id"] for h, _ in records]
    assert len(set(ids)) == len(ids) - 1  # the two rows that are equal in all columns
    by_id = {h["warc-record-id"]: (h, b) for h, b in records}
    for h, b in records:
        body = b.partition(b"\r\n\r\n")[2]
        if h["warc-type"] == "revisit":
            original, content = by_id[h["warc-refers-to"]]
            assert body == b"" and original["warc-type"] == "response" and original["warc-payload-digest"] == h["warc-payload-digest"]
            assert hashlib.sha1(content.partition(b"\r\n\r\n")[2]).hexdigest() == h["warc-payload-digest"][5:]
    assert all(h["warc-date"].startswith("20") and h["warc-date"].endswith("Z") for h, _ in records)
    assert sorted(len([1 for f in [p] for _ in warc.parse(__import__("gzip").open(f))]) for p in (tmp_path / "a").glob("part-*"))[-1] <= 3


def test_damaged_archive_is_told(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(1, "u", "x" * 50)], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.write_archives(warc.resolve(pages), path)
    file = next(f for f in (tmp_path / "a").glob("part-*") if gzip.open(f).read(1))
    data = gzip.decompress(file.read_bytes())
    assert [h["warc-type"] for h, _ in read_all(tmp_path / "a")] == ["response"] and data.endswith(b"\r\n\r\n")
    file.write_bytes(gzip.compress(data.replace(b"xxxx", b"yyyy")))
    for crc in (tmp_path / "a").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark, path).collect()


def test_lost_original_is_told(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 1500), (2, "u", "x" * 1500)], "page_id long, url string, html string")
    path = str(tmp_path / "a")
    warc.write_archives(warc.resolve(pages).filter("record_type = 'revisit'"), path)
    with pytest.raises(Exception, match="no original"):
        warc.read_archives(spark, path).collect()
