"""Physical plans: what is pruned, how often rows move, and that no Python runs."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import batch, exports, ranges, reports
from tallyworks.plans.workspace import DATASETS, Workspace
from tallyworks.proof import oracle, proxies


def plan(frame) -> str:
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    """The sheets as Parquet, partitioned by the last day of the file's year."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rebuilt, root = proxies.workspace(spark, sf_dir), tmp_path_factory.mktemp("lake")
    frames = {}
    for name, frame in rebuilt.frames.items():
        if "_dt" in frame.columns:
            year = frame.withColumn("_dt", F.concat(F.substring("_dt", 1, 4), F.lit("1231")))
            year.repartition("_dt").write.partitionBy("_dt").parquet(f"{root}/{name}")
        else:
            frame.write.parquet(f"{root}/{name}")
        frames[name] = spark.read.schema(frame.schema).parquet(f"{root}/{name}")
    return Workspace(spark, frames, prefixes=rebuilt.prefixes, excluded_codes=rebuilt.excluded_codes)


@pytest.mark.parametrize("name", DATASETS)
def test_no_python_and_no_cartesian_product(landed, name):
    text = plan(landed.get(name))
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct|NestedLoop", text)


@pytest.mark.parametrize("name", ["rt_cnt_clean", "rt_tmspt_clean", "rt_pr_hh24_clean", "monitor_log"])
def test_dedup_cuts_rows_before_its_only_shuffle(landed, name):
    text = plan(landed.get(name))
    assert text.count("Exchange hashpartitioning") == 1
    before = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


@pytest.mark.parametrize("name, shuffles", [("rt_cnt_daily", 1), ("rt_cnt_daily_with_tmspt", 2)])
def test_day_rollup_reuses_the_dedup_partitioning(landed, name, shuffles):
    assert plan(landed.get(name)).count("Exchange hashpartitioning") == shuffles


def test_without_broadcast_the_day_join_still_adds_no_shuffle(spark, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(landed.get("rt_cnt_daily_with_tmspt"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_reports_prune_landed_days_and_columns(landed):
    text = plan(reports.history_totals(landed, oracle.P))
    assert "(_dt >= 19980101)" in text and "(_dt <= 1999" in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "_sheet" not in scan and "_ingest_ts" not in scan


def test_reports_compute_only_what_they_show(landed):
    text = plan(reports.history_totals(landed, oracle.P))
    assert "max_by" not in text and "avg_tm_ms" not in text and "SortAggregate" not in text


def test_filters_reach_the_log_scan(landed):
    text = plan(landed.get("monitor_daily"))
    assert "EqualTo(monitor_kind,SERVER)" in text and "IsNotNull(target_ip)" in text
    trailing = plan(exports.export_rows(landed.get("monitor_daily"), "daily"))
    assert "TakeOrderedAndProject" in trailing
    # the bound on the date is applied to the log rows, below the dedup
    above, below = trailing.split("Filter (_rank = 1)")[:2]
    assert "Subquery" not in above and re.search(r"Filter .*createtime.*Subquery", below)


def test_registry_is_joined_to_aggregates(landed):
    lines = plan(landed.get("monitor_daily")).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate" in line and "used_cpu_rate" in line for line in lines[join + 1:])
    assert not any("HashAggregate" in line and "used_cpu_rate" in line for line in lines[:join])


def test_written_months_are_pruned(spark, landed, tmp_path):
    run = batch.write_silver(landed, oracle.P, str(tmp_path))
    text = plan(reports.volume_of_month(run, oracle.P))
    assert re.search(r"PartitionFilters: \[[^\]]*tx_yyyymm[^\]]*1998-05", text)
    assert "Window" not in text


def test_reports_of_a_run_read_codes_and_totals_from_one_pass(landed, tmp_path):
    run = batch.write_silver(landed, oracle.P, str(tmp_path))
    for build in (reports.all_categories, reports.top_updates, reports.month_over_month, reports.range_details,
                  reports.range_details_compared, reports.range_volume_compared):
        frame = build(run, oracle.P)
        assert "Window" not in plan(frame) and "rt_pr_hh24_clean" not in plan(frame)
        rows = sorted(map(str, frame.collect()))
        assert rows and rows == sorted(map(str, build(landed, oracle.P).collect()))


def test_a_date_range_reads_the_landed_days_that_can_hold_it(landed):
    first, last = dt.date(1998, 5, 1), dt.date(1998, 5, 31)
    for frame in (landed.between("monthly_transaction_stats", first, last),
                  landed.sql("SELECT * FROM monthly_transaction_stats", (first, last))):
        text = plan(frame)
        assert "PartitionFilters: []" not in text.split("rt_pr_hh24")[0] and re.search(r"PartitionFilters: \[[^\]]*_dt", text)
    whole = landed.get("monthly_transaction_stats").filter("ym = '1998-05'")
    assert sorted(landed.between("monthly_transaction_stats", first, last).collect()) == sorted(whole.collect())
    for name in ("rt_cnt_daily", "rt_cnt_monthly", "rt_cnt_daily_with_tmspt"):
        whole = landed.get(name).filter("ym = '1998-05'")
        assert sorted(map(str, landed.between(name, first, last).collect())) == sorted(map(str, whole.collect()))


RANGE = "(DATE'1998-05-01', DATE'1998-05-31')"


@pytest.mark.parametrize("name", [*ranges.RANGED, *ranges.DAYS])
def test_table_functions_give_what_between_gives(landed, name):
    first, last = dt.date(1998, 5, 1), dt.date(1998, 5, 31)
    dataset = ranges.DAYS.get(name) or ranges.RANGED[name].dataset
    frame, expected = landed.sql(f"SELECT * FROM {name}{RANGE}"), landed.between(dataset, first, last)
    assert frame.columns == expected.columns
    rows = sorted(map(str, frame.collect()))
    assert rows and rows == sorted(map(str, expected.collect()))


def test_table_functions_read_the_landed_days_that_can_hold_the_range(spark, landed):
    for name in (n for n, ranged in ranges.RANGED.items() if ranged.keyed):
        text = plan(landed.sql(f"SELECT * FROM {name}{RANGE}"))
        assert re.search(r"PartitionFilters: \[[^\]]*\(_dt >= 19980501\)[^\]]*\(_dt <= 1999", text), text
        assert text.count("Exchange hashpartitioning") <= 1 and "Join" not in text
    joined = landed.sql(f"""SELECT h.pr_id, sum(h.tx_cnt) AS n, max(c.total_cnt) AS most FROM rt_pr_hh24_between{RANGE} h
        JOIN rt_cnt_between{RANGE} c ON h.pr_id = c.pr_id AND h.tx_dt = c.tx_dt GROUP BY h.pr_id""")
    assert joined.count()
    assert landed.sql("SELECT * FROM rt_cnt_between(NULL, DATE'1998-05-31')").count() == 0


def test_table_functions_of_sheets_that_have_not_landed(spark, landed):
    some = Workspace(spark, {"rt_cnt": landed.get("rt_cnt")})
    assert ranges.register(some) == ["rt_cnt_between", "rt_cnt_daily_between"]
