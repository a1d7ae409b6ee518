import duckdb
import pytest

from offerloom.llm import registry
from tests.test_oracles import compare

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    compare(registry.QUERIES[name](spark, SF), db.execute(registry.ORACLES[name]))
