from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUICK = ["clean_transactions", "val_duplicates", "amount_by_class", "stratified_split", "metrics_by_experiment",
         "threshold_grid", "drift_wasserstein", "rate_5m", "label_join_metrics"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    order = [want.columns.index(c) for c in columns]
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, (tuple(r[i] for i in order) for r in want.fetchall())))


def test_every_sql_parses(con):
    for name, sql in entry.oracle_sql().items():
        con.sql(f"EXPLAIN {sql}").fetchall()
