"""Every registered query against its SQL, plainly and with every group above the row limit."""

from __future__ import annotations

import duckdb
import pytest
from check import TABLES, compare

import __spark_entry__ as entry
from tests.conftest import SF_DIR

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Queries whose plan depends on the row limit of a group.
SKEW_AWARE = [
    "win_rank", "win_lag_lead", "win_running", "win_moving_rows", "win_moving_range", "win_moving_extremes", "join_left", "join_right",
    "join_full", "join_asof_window", "join_split_skew", "bucket_join", "agg_percentile", "scd2_build", "asof_version",
    "pandas_grouped",
]


@pytest.mark.parametrize("key", list(QUERIES))
def test_same_as_sql(spark, duck, key):
    verdict = compare(spark, duck, key, SF_DIR, QUERIES, SQL)
    assert verdict == "ok" or (key not in SQL and verdict.startswith("rows-only")), verdict


@pytest.mark.parametrize("key", SKEW_AWARE)
def test_same_with_hot_groups(spark, duck, conf, key):
    conf(spark__weftline__hotRows="3")
    verdict = compare(spark, duck, key, SF_DIR, QUERIES, SQL)
    assert verdict == "ok", verdict


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    first = entry.entry(spark).first()
    assert (first["o_orderpriority"], round(first["revenue"], 4), first["n"]) == ("5-LOW", 7739051.5609, 151)


# A third of the rows of each table gets one key.
SKEWED = {
    "lineitem": "l_orderkey = CASE WHEN row_number() OVER () % 3 = 0 THEN 7 ELSE l_orderkey END",
    "orders": "o_custkey = CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END",
    "events": "user_id = CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("skewed"), duckdb.connect()
    for t in TABLES:
        source, target = f"read_parquet('{SF_DIR}/{t}.parquet')", folder / f"{t}.parquet"
        column, _, value = SKEWED.get(t, "").partition(" = ")
        replaced = f"REPLACE ({value} AS {column})" if column else ""
        con.sql(f"COPY (SELECT * {replaced} FROM {source}) TO '{target}' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{target}')")
    return str(folder), con


@pytest.mark.parametrize("key", [*SKEW_AWARE, "win_share", "win_topn", "join_semi", "join_anti", "st_interval_join"])
def test_same_on_skewed_tables(spark, skewed, conf, key):
    conf(spark__weftline__hotRows="100")
    folder, con = skewed
    verdict = compare(spark, con, key, folder, QUERIES, SQL)
    assert verdict == "ok", verdict


# Each column of these tables is null in some rows, keys included.
HOLED = ["orders", "events", "lineitem", "customer", "part"]
NULL_SAFE = [
    k for k in QUERIES
    if k in SQL and not k.startswith(("op", "pipeline", "fn_", "filter_", "sort_", "union_"))
]


@pytest.fixture(scope="module")
def holed(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("holed"), duckdb.connect()
    for t in TABLES:
        source, target = f"read_parquet('{SF_DIR}/{t}.parquet')", folder / f"{t}.parquet"
        columns = [r[0] for r in con.sql(f"DESCRIBE SELECT * FROM {source}").fetchall()]
        holes = [f"CASE WHEN _n % {61 + 7 * i} <> {i + 3} THEN {c} END AS {c}" for i, c in enumerate(columns)]
        kept = ", ".join(holes if t in HOLED else columns)
        con.sql(f"COPY (SELECT {kept} FROM (SELECT *, row_number() OVER () AS _n FROM {source})) TO '{target}' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{target}')")
    return str(folder), con


@pytest.mark.parametrize("key", NULL_SAFE)
def test_same_on_tables_with_nulls(spark, holed, key):
    folder, con = holed
    verdict = compare(spark, con, key, folder, QUERIES, SQL)
    assert verdict == "ok", verdict
