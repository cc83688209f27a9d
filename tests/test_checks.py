"""Every registered query against its SQL twin, and what their plans must look like."""

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from matchloom.plans.checks import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value if isinstance(value, str) else repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, FOLDER)
    found = df.collect()
    result = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, found) == sorted_rows(names, expected)


def test_contract_needs_no_session():
    code = "import __spark_entry__ as e; from matchloom.plans.checks import all_queries as q; assert q().keys() <= e.oracle_sql().keys() and len(q()) > 90"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name):
    return plan(entry.queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["subset_filter", "drop_sentinels", "unmatched_keys"])
def test_filters_reach_the_scan(spark, name):
    pushed = [line for line in query_plan(spark, name).splitlines() if "PushedFilters: [" in line]
    assert any("PushedFilters: [Is" in p or "PushedFilters: [Or" in p or "PushedFilters: [In" in p or "PushedFilters: [Not" in p for p in pushed)


@pytest.mark.parametrize("name", ["select_existing", "front_columns", "side_split", "iso_date_filter", "season_code", "match_id48", "slug_parse"])
def test_no_python_in_plain_queries(spark, name):
    assert "Python" not in query_plan(spark, name) and "InArrow" not in query_plan(spark, name)


@pytest.mark.parametrize("name", ["front_columns", "select_existing", "slug_parse", "strip_accents", "page_links", "season_complete", "table_first"])
def test_row_by_row_queries_do_not_shuffle(spark, name):
    text = query_plan(spark, name)
    assert "Exchange hashpartitioning" not in text and "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", sorted(set(all_queries()) - {"stream_incremental", "drop_empty_columns"}))
def test_no_cross_joins_and_no_single_partition_windows(spark, name):
    text = query_plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    windows = [i for i, line in enumerate(text.splitlines()) if " Window [" in line or " Window(" in line]
    following = text.splitlines()
    assert not any("SinglePartition" in line for i in windows for line in following[i : i + 4])


def test_series_windows_run_within_buckets(spark):
    text = query_plan(spark, "forward_fill")
    heavy = [line for line in text.splitlines() if "Window [last" in line]
    assert heavy and any("user_id" in line and "_bucket" in line for line in heavy)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
