import duckdb
import pytest

import __spark_entry__ as entry
from stratum.queries import ORACLES
from stratum.sources.tables import TABLE_NAMES, table_path
from tests.conftest import SMALL

def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year_month", "store_id", "product_id", "monthly_revenue", "monthly_margin",
                          "transaction_count"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle_at_smallest_scale(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    idx = [res.columns.index(c) for c in df.columns]
    ours = sorted((tuple(r) for r in df.collect()), key=repr)
    theirs = sorted((tuple(r[i] for i in idx) for r in res.fetchall()), key=repr)
    assert ours == theirs
