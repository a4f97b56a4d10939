"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb
import pytest

from tallyworks.plans.reports import REPORTS, sort_columns
from tallyworks.proof.catalog import CHECKS, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, key):
    frame = QUERIES[key](spark, sf_dir)
    found = table(frame.columns, frame.collect())
    cursor = duck.execute(CHECKS[key])
    expected = table([d[0] for d in cursor.description], cursor.fetchall())
    assert found == expected


# delivered orders: the rows of these come in the order of their SQL sorted by the same columns
DAY, PORT = "application NULLS LAST, target_ip NULLS LAST, log_date DESC NULLS LAST", "target_port NULLS LAST"
ORDERS = {
    "e1_daily_export": DAY, "e2_hourly_export": f"{DAY}, log_hour DESC NULLS LAST", "e1_daily_jvm_export": f"{DAY}, {PORT}",
    "e2_hourly_jvm_export": f"{DAY}, log_hour DESC NULLS LAST, {PORT}",
    "o1_mixed_order": "log_date DESC NULLS LAST, log_hour DESC NULLS LAST, max_used_heap_mem_rate DESC NULLS LAST",
    "o2_top_rows": "tx_cnt DESC NULLS LAST, tx_hour_ts NULLS LAST, pr_id NULLS LAST, node_id NULLS LAST",
    "r7_top_updates": "total_cnt DESC, pr_id", "r8_top_queries": "total_cnt DESC, pr_id",
}


@pytest.mark.parametrize("key", sorted(ORDERS))
def test_rows_come_in_the_order_of_the_sql(spark, sf_dir, duck, key):
    columns = [part.split()[0] for part in ORDERS[key].split(", ")]
    found = [tuple(map(plain, row)) for row in QUERIES[key](spark, sf_dir).select(*columns).collect()]
    rows = duck.execute(f"SELECT {', '.join(columns)} FROM ({CHECKS[key]}) ORDER BY {ORDERS[key]}").fetchall()
    assert found and found == [tuple(map(plain, row)) for row in rows]


@pytest.mark.parametrize("number, key, order", [
    ("7", "r6_all_categories", "category NULLS LAST, total_cnt DESC, pr_id"),
    ("8", "r18_range_details", "category DESC NULLS LAST, total_cnt DESC, pr_id"),
])
def test_reports_are_sorted_as_the_sql(spark, sf_dir, duck, number, key, order):
    report, frame = next(r for r in REPORTS if r.number == number), QUERIES[key](spark, sf_dir)
    found = [row.pr_id for row in frame.orderBy(*sort_columns(report, frame)).select("pr_id").collect()]
    assert found and found == [row[0] for row in duck.execute(f"SELECT pr_id FROM ({CHECKS[key]}) ORDER BY {order}").fetchall()]


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == CHECKS.keys()
