"""Every registered query against its independent DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from pubspark.plans.catalog import QUERIES
from pubspark.plans.oracle import ORACLE_SQL
from tools.check_oracle import TABLES, canon, type_mismatches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, shared_landings, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in cur.description]
    otypes = [d[1] for d in cur.description]
    sc, sv = canon(df.columns, [tuple(r) for r in df.collect()])
    oc, ov = canon(ocols, cur.fetchall())
    assert sc == oc
    assert type_mismatches(df.dtypes, ocols, otypes) == []
    assert sv == ov


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["author_name", "publication_count", "first_author_count"]
    assert 0 < len(rows) <= 20
