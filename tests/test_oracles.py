"""Every query that has SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from offerloom import registry

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return db


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v.isoformat(" ") if hasattr(v, "isoformat") else v


def compare(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(d[0] for d in want.description)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert len(a) == len(b)
    assert [x for x, y in zip(a, b) if x != y][:5] == [y for x, y in zip(a, b) if x != y][:5]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    compare(registry.QUERIES[name](spark, SF), duck.execute(registry.ORACLES[name]))


def test_entry(spark):
    assert entry.entry(spark).count() > 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
