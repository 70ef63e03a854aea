"""Every registered driver query against its DuckDB oracle on the smallest driver tables."""
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tools.plan_lint import FORBIDDEN

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
# the training-data operators have tests of their own
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert cols == sorted(rel.columns)
    want = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["process_id", "doc_type", "document_id"]


@pytest.mark.parametrize("name", ["timestamp_formats", "child_explode", "spec_processes_main", "spec_people_main"])
def test_timestamps_do_not_depend_on_session_zone(spark, con, name):
    """Daylight-saving gaps of the session zone must not move zone-less timestamps."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
