"""Dictionary attributes of titles and pairs."""

import random

import pytest
from pyspark.sql import functions as F

from offerloom.operators import features
from offerloom.operators import name_attributes as na

#: category, name, groups of synonyms
WORDS = [
    ("tools", "power", [["cordless"], ["mains", "corded"], ["air driven", "pneumatic"], ["gas driven", "pneumatic"], ["heavy duty air driven"]]),
    ("tools", "hand", [["left"], ["right"]]),
    ("tools", "size", [["5-10"], ["XL"], [" small "]]),
    ("toys", "power", [["cordless"], ["wind up"]]),
]
DICTIONARY = [(c, n, f"{n}{k}", v) for c, n, groups in WORDS for k, g in enumerate(groups) for v in g]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "category string, name string, group_id string, value string")


# category, titles, any common, share met, agree soft, agree hard
CASES = [
    ("tools", "bosch drill cordless", "makita cordless saw", 1.0, 1.0, True, True),
    ("tools", "bosch drill", "makita saw", 0.0, 0.0, True, True),
    ("tools", "drill cordless", "drill cordles", 0.0, 0.0, True, True),  # a typo is no attribute
    ("tools", "drill cordless", "drill mains", 1.0, 0.0, False, False),
    ("tools", "drill corded", "drill mains", 1.0, 1.0, True, True),
    ("tools", "drill air driven", "drill pneumatic", 1.0, 1.0, True, True),
    ("tools", "drill air driven", "drill gas driven", 1.0, 1.0, True, False),
    ("tools", "drill air", "drill driven air", 0.0, 0.0, True, True),
    ("tools", "heavy duty air driven left drill", "cordless left", 1.0, 0.5, False, False),
    ("tools", "small drill left", "drill right small 5-10 XL", 1.0, 0.5, False, False),
    ("toys", "drill mains", "drill cordless", 0.0, 0.0, True, True),  # of another category
    ("garden", "drill cordless", "drill cordless", 0.0, 0.0, True, True),  # of an unknown category
    ("tools", "", None, 0.0, 0.0, True, True),
    (None, "cordless", "cordless", 0.0, 0.0, True, True),
]


def test_pairs(spark, dictionary):
    pairs = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(CASES)], "k int, category string, product_name string, name string")
    rows = features.evaluate(na.with_attributes(pairs, dictionary), ["i_nameattributes", "r_nameattributes"])
    a, b = F.col("product_attributes"), F.col("offer_attributes")
    rows = rows.withColumns({"soft": na.agree(a, b), "hard": na.agree(a, b, soft=False)}).orderBy("k").collect()
    assert [(r.i_nameattributes, r.r_nameattributes, r.soft, r.hard) for r in rows] == [c[3:] for c in CASES]
    assert [(x.name, x.synonyms) for x in rows[8].product_attributes] == [("hand", ["left"]), ("power", ["air driven", "heavy duty air driven", "pneumatic"])]


def test_values_by_brute_force(spark):
    """Against all runs of words of each title, with long values that begin alike."""
    rng = random.Random(9)
    phrase = lambda most: " ".join(rng.choices("ab", k=rng.randint(1, most)))
    values = sorted({(c, phrase(7)) for c in ("x", "y") for _ in range(40)})
    titles = sorted({(rng.choice("xyz"), phrase(12)) for _ in range(150)}) + [("x", ""), ("y", "a  b")]
    got = na.found_values(spark.createDataFrame(titles + titles[:5], "category string, title string"), spark.createDataFrame(values, "category string, value string"))
    want = set()
    for c, title in titles:
        w = title.split(" ")
        runs = {" ".join(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        want |= {(c, title, v) for v_c, v in values if v_c == c and v in runs}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty(spark, dictionary):
    pairs = spark.createDataFrame([("tools", "cordless", "cordless")], "category string, product_name string, name string")
    assert na.with_attributes(pairs, dictionary.limit(0)).first().offer_attributes == []
    assert na.with_attributes(pairs.limit(0), dictionary).collect() == []
