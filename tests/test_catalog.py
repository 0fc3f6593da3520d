"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from conftest import SMALL_SF
from __spark_entry__ import entry
from marquee.plans.catalog import ORACLES, QUERIES
from marquee.sources.tables import BENCH_TABLES
from tools.oracle_check import digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BENCH_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL_SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[1] == digest(cols, want)[1]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["segment", "supplier_name", "line_count", "avg_price", "total_size",
                          "influence_score"]
    assert df.count() == 49


PAIRS = sorted(name[:-3] for name in QUERIES if name.endswith("_df") and name[:-3] + "_sql" in QUERIES)


@pytest.mark.parametrize("stem", PAIRS)
def test_dataframe_and_sql_forms_agree(spark, stem):
    df_form = QUERIES[stem + "_df"](spark, SMALL_SF)
    sql_form = QUERIES[stem + "_sql"](spark, SMALL_SF)
    assert df_form.columns == sql_form.columns
    assert digest(df_form.columns, [tuple(r) for r in df_form.collect()])[1] == \
        digest(sql_form.columns, [tuple(r) for r in sql_form.collect()])[1]
