"""Landing, from decoded rows to a run of all reports."""

from __future__ import annotations

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.plans import batch, clean, exports
from tallyworks.plans.params import ReportParams
from tallyworks.plans.reports import REPORTS, Report, volume_of_month
from tallyworks.plans.workspace import Workspace
from tallyworks.sources import csvout, lake, landing
from tallyworks.sources.schemas import LABELS
from tallyworks.sources.texts import sql_files
from tallyworks.streaming.landing_stream import land_available


def put(root, sheet, file, *rows):
    folder = root / f"_sheet={sheet}" / f"_file={file}"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def hour(code, caltm, avg, cnt):
    return {"PR_ID": code, "CALTM": caltm, "AVG_TM": avg, "CNT": cnt}


@pytest.fixture()
def inbox(tmp_path):
    root = tmp_path / "inbox"
    put(root, "RT_PR_HH24", "daily-20260402.xlsx", hour("G61 ", "0401 09", 0.25, 4.0), hour("G61", "0401 10", 0.5, 2.0),
        {"PR_ID": " ", "CALTM": None, "AVG_TM": None, "CNT": None})
    put(root, "RT_PR_HH24", "daily-20260403.xlsx", hour("G61", "0401 10", 0.75, 8.0), hour("P94", "0402 10", 1.0, 1.0))
    put(root, "RT_PR_HH24", "notes-20260404.txt", hour("P94", "0404 10", 1.0, 1.0))
    put(root, "MON_LOG", "daily-20260403.xlsx", {
        "MONITOR_KIND": "SERVER", "TARGET_IP": "10.0.0.1", "TARGET_PORT": 1, "CREATETIME": "2026-04-01 10:00:00",
        "MON_CONTENT": "虛擬伺服器資源使用狀況-監控結果資訊：usedCPURate:12.50%,totalMem:8.00,freeMem:2.00,usedMemRate:75%"})
    return root


def outcomes(frame):
    return {r._file: (r.outputs, r.processed) for r in frame.collect()}


def test_incremental_then_force(spark, inbox, tmp_path):
    target = str(tmp_path / "lake")
    first = landing.land(spark, str(inbox), target, newest=1, ingest_ts=1)
    assert outcomes(first) == {"daily-20260403.xlsx": (2, True)}
    second = landing.land(spark, str(inbox), target, ingest_ts=2)
    assert outcomes(second) == {"daily-20260402.xlsx": (1, True), "daily-20260403.xlsx": (0, False)}
    assert outcomes(landing.land(spark, str(inbox), target)) == {
        "daily-20260402.xlsx": (0, False), "daily-20260403.xlsx": (0, False)}
    forced = landing.land(spark, str(inbox), target, date="20260402", force=True, ingest_ts=3)
    assert outcomes(forced) == {"daily-20260402.xlsx": (1, True)}
    rows = lake.read_sheet(spark, target, "RT_PR_HH24").collect()
    assert sorted((r._dt, r._ingest_ts, r._file, r._sheet) for r in rows) == sorted(
        [("20260402", 3, "daily-20260402.xlsx", "RT_PR_HH24")] * 2 + [("20260403", 1, "daily-20260403.xlsx", "RT_PR_HH24")] * 2)
    summary = landing.landing_summary(lake.read_sheet(spark, target, "RT_PR_HH24")).collect()
    assert {(r._dt, r.row_count, r.file_count) for r in summary} == {("20260402", 2, 1), ("20260403", 2, 1)}


def test_a_day_without_a_record_is_landed_again_without_doubling(spark, inbox, tmp_path):
    """A run lost after its write and before its record."""
    target = str(tmp_path / "lake")
    raw = spark.read.schema(T.StructType([*landing.cell_schema("RT_PR_HH24").fields, T.StructField("_file", T.StringType())]))
    rows = landing.select_files(raw.json(f"{inbox}/_sheet=RT_PR_HH24"))
    lake.write_days(landing.prepare(rows, "RT_PR_HH24", 1, lake.header_schema(landing.SHEET_COLUMNS["RT_PR_HH24"])), target)
    landing.land(spark, str(inbox), target, ingest_ts=2)
    found = lake.read_sheet(spark, target, "RT_PR_HH24")
    assert found.count() == 4 and {r._ingest_ts for r in found.collect()} == {2}


def test_empty_inbox_and_missing_lake(spark, tmp_path):
    assert landing.land(spark, str(tmp_path / "none"), str(tmp_path / "lake")).count() == 0
    assert lake.open_lake(spark, str(tmp_path / "lake")) == {}


def test_headers(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    found = landing.with_clean_headers(frame, [" x ", "", "x", None])
    assert found.columns == ["x", "column_1", "column_3"] and tuple(found.collect()[0]) == (3, 2, 4)


def test_values(spark):
    schema = "s string, n double, t timestamp_ntz, d date, b boolean"
    rows = [("  ", 12.0, dt.datetime(2026, 4, 1), dt.date(2026, 4, 1), True),
            (" a ", -0.5, dt.datetime(2026, 4, 1, 10, 0, 0, 500), None, None), (None, None, None, None, None),
            ("\t", None, None, None, None), ("z", 1e18, dt.datetime(2026, 4, 1, 23, 59, 59), None, False)]
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    assert [tuple(r) for r in landing.normalise(landing.drop_blank_rows(frame)).collect()] == [
        (None, "12", "2026-04-01", "2026-04-01", True), (" a ", "-0.5", "2026-04-01T10:00:00.000500", None, None),
        ("z", "1000000000000000000", "2026-04-01T23:59:59.000000", None, False)]


def test_file_selection(spark):
    names = ["daily-20260401.xlsx", "daily-20260402.xlsx", "daily-2026.xlsx", "daily-20260403.xls", "x20260404.xlsx"]
    frame = spark.createDataFrame([(n,) for n in names], "_file string")
    assert {r._dt for r in landing.select_files(frame).collect()} == {"20260401", "20260402", "20260404"}
    assert {r._dt for r in landing.select_files(frame, r"daily-(\d{8})\.xlsx", newest=1).collect()} == {"20260402"}
    assert [r._dt for r in landing.select_files(frame, date=" 20260401 ", newest=5).collect()] == ["20260401"]


def test_stream_lands_each_file_once(spark, inbox, tmp_path):
    schema = landing.cell_schema("RT_PR_HH24")
    args = (spark, str(inbox), str(tmp_path / "stream"), "RT_PR_HH24", schema, str(tmp_path / "checkpoint"))
    types = lake.header_schema(landing.SHEET_COLUMNS["RT_PR_HH24"])
    land_available(*args, types=types)
    put(inbox, "RT_PR_HH24", "daily-20260405.xlsx", hour("P94", "0404 10", 1.0, 1.0))
    land_available(*args, types=types)
    land_available(*args, types=types)
    rows = lake.read_sheet(spark, str(tmp_path / "stream"), "RT_PR_HH24").collect()
    assert sorted(r._file for r in rows) == ["daily-20260402.xlsx"] * 2 + ["daily-20260403.xlsx"] * 2 + ["daily-20260405.xlsx"]


def test_stream_lands_touched_workbooks_whole(spark, inbox, tmp_path):
    name, where = "RT_PR_HH24", str(tmp_path / "stream")
    types = lake.header_schema(landing.SHEET_COLUMNS[name])

    def run():
        land_available(spark, str(inbox), where, name, landing.cell_schema(name), str(tmp_path / "checkpoint"), types=types)
        rows = spark.read.option("mergeSchema", "true").option("basePath", where).parquet(f"{where}/_sheet={name}")
        return rows, sorted((r._file, r.CALTM) for r in rows.collect())

    first = [("daily-20260402.xlsx", "0401 09"), ("daily-20260402.xlsx", "0401 10"),
             ("daily-20260403.xlsx", "0401 10"), ("daily-20260403.xlsx", "0402 10")]
    assert run()[1] == first
    late = [hour("P94", "0401 11", 1.0, 1.0) | {"REMARK": "late"}, hour("P95", "0401 12", "n/a", 1.0)]
    folder = inbox / f"_sheet={name}" / "_file=daily-20260402.xlsx"
    (folder / "part-1.json").write_text("\n".join([*map(json.dumps, late), "no json"]), encoding="utf-8")
    rows, found = run()
    whole = sorted([*first, ("daily-20260402.xlsx", "0401 11"), ("daily-20260402.xlsx", "0401 12")])
    assert found == whole and [r.CALTM for r in rows.filter("REMARK = 'late'").collect()] == ["0401 11"]
    bad = {(r._dt, r.header, r.content) for r in landing.rejected_cells(spark, where).collect()}
    assert bad == {("20260402", "AVG_TM", "n/a"), ("20260402", None, "no json")}
    # second workbooks of landed days, by name before and after the first: the landed rows stay
    put(inbox, name, "again-20260402.xlsx", hour("X", "0401 01", 1.0, 1.0))
    put(inbox, name, "later-20260403.xlsx", hour("X", "0401 01", 1.0, 1.0))
    assert run()[1] == whole
    # of two new workbooks of one day the first by name, as in batch landing
    put(inbox, name, "b-20260406.xlsx", hour("X", "0405 02", 1.0, 1.0))
    put(inbox, name, "a-20260406.xlsx", hour("X", "0405 01", 1.0, 1.0))
    assert run()[1] == sorted([*whole, ("a-20260406.xlsx", "0405 01")])
    log = {r._dt: (r._file, r.row_count, r.rejected) for r in landing.landing_log(spark, where).collect()}
    assert log == {"20260402": ("daily-20260402.xlsx", 4, 2), "20260403": ("daily-20260403.xlsx", 2, 0), "20260406": ("a-20260406.xlsx", 1, 0)}


@pytest.fixture()
def workspace(spark, inbox, tmp_path):
    landing.land(spark, str(inbox), str(tmp_path / "lake"))
    codes, registry = tmp_path / "codes.csv", tmp_path / "registry.jsonl"
    codes.write_text("順序\t交易類型\t交易名稱\t電文分類\t交易名稱(調整)\n1\tG61\tname, one\tupdate\t\n2\tP94\t\tquery\tx\n", encoding="utf-8")
    registry.write_text('{"application": "app", "ipAddr": "10.0.0.1", "port": 1, "other": 2}\n', encoding="utf-8")
    return Workspace.open(spark, str(tmp_path / "lake"), str(codes), str(registry))


def test_all_reports_from_an_inbox(spark, workspace, tmp_path):
    params = ReportParams.resolve(target_month="2026-04")
    status = batch.run_reports(workspace, params, str(tmp_path / "out"), work=str(tmp_path / "work"))
    found = {r.number: (r.rows, r.ok) for r in status.collect()}
    assert len(found) == len(REPORTS) and all(ok for _, ok in found.values())
    assert found["1"] == (2, True) and found["1.1"] == (1, True) and found["7.1"] == (1, True)
    page = csvout.read_csv(spark, str(tmp_path / "out" / "8.交易量統計-所有交易類別-詳細資訊")).collect()
    assert {(r["交易類型"], r["名稱"], r["交易總量"], r["峰值處理時間"]) for r in page} == {
        ("G61", "name, one", "12", "115/04/01\n583"), ("P94", "未定義名稱", "1", "115/04/02\n1000")}
    saved = json.loads(spark.read.text(str(tmp_path / "out" / "parameters"), wholetext=True).collect()[0][0])
    assert saved["target_month"] == "2026-04"


def test_a_run_without_data_delivers_messages(spark, workspace, tmp_path):
    params = ReportParams.resolve(target_month="2026-08")
    status = batch.run_reports(workspace, params, str(tmp_path / "out"))
    found = {r.number: r.rows for r in status.collect()}
    assert found["1"] == 0 and found["2.1"] == 1 and found["3.1"] == 1
    message = csvout.read_csv(spark, str(tmp_path / "out" / "3.1.交易量統計-峰日峰時-Pivot")).collect()
    assert message[0].Message == "No data for report 3.1.交易量統計-峰日峰時-Pivot under current parameters"
    header = csvout.read_csv(spark, str(tmp_path / "out" / "1.交易量統計-當月"))
    assert header.columns == ["pr_id", "total_cnt", "active_days"] and header.count() == 0


def test_failures_stop_or_continue(spark, workspace, tmp_path):
    def broken(ws, params):
        raise ValueError("no such thing")

    plan = [Report("10", "10.last", volume_of_month, ("pr_id",)), Report("2", "2.broken", broken, ())]
    params = ReportParams.resolve(target_month="2026-04")
    with pytest.raises(batch.ReportRunFailed, match="stopped at the first") as stopped:
        batch.run_reports(workspace, params, str(tmp_path / "a"), plan)
    assert [(r.number, r.ok, r.error) for r in stopped.value.status.collect()] == [("2", False, "no such thing")]
    with pytest.raises(batch.ReportRunFailed, match="with failures") as finished:
        batch.run_reports(workspace, params, str(tmp_path / "b"), plan, continue_on_error=True)
    assert [(r.number, r.ok) for r in finished.value.status.orderBy("position").collect()] == [("2", False), ("10", True)]


def test_reports_run_at_once_as_if_one_by_one(spark, workspace, tmp_path):
    """A run that stops leaves what a sequential run leaves: nothing after the failure, earlier deliveries untouched."""
    params, finished = ReportParams.resolve(target_month="2026-04"), threading.Event()

    def late_failure(ws, params):
        assert finished.wait(60)
        raise ValueError("too late")

    def quick(ws, params):
        finished.set()
        return volume_of_month(ws, params)

    plan = [Report("1", "1.first", volume_of_month, ("pr_id",)), Report("2", "2.broken", late_failure, ()),
            Report("3", "3.third", quick, ("pr_id",))]
    out = tmp_path / "stops"
    (out / "3.third").mkdir(parents=True)
    (out / "3.third" / "part-old.csv").write_text("of an earlier run\n", encoding="utf-8")
    with pytest.raises(batch.ReportRunFailed, match="stopped at the first") as stopped:
        batch.run_reports(workspace, params, str(out), plan)
    assert [(r.position, r.ok) for r in stopped.value.status.orderBy("position").collect()] == [(1, True), (2, False)]
    assert sorted(p.name for p in out.iterdir()) == ["1.first", "3.third", "parameters", "status"]
    assert [p.name for p in (out / "3.third").glob("part-*")] == ["part-old.csv"]
    assert csvout.read_csv(spark, str(out / "1.first")).count() == 2


def test_reports_from_query_files(spark, workspace, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    (folder / "10.late.sql").write_text("SELECT 1 AS one", encoding="utf-8")
    (folder / "9.1.每日 total.sql").write_text(
        "SELECT pr_id, sum(tx_cnt) AS n FROM rt_pr_hh24_clean WHERE tx_yyyymm = '${targetMonth}' "
        "GROUP BY pr_id ORDER BY n DESC", encoding="utf-8")
    (folder / "plain.sql").write_text("SELECT '${rangeStartDate}' AS d", encoding="utf-8")
    found = [batch.report_from_sql(name, text) for name, text in sql_files(spark, str(folder)).items()]
    status = batch.run_reports(workspace, ReportParams.resolve(target_month="2026-04"), str(tmp_path / "out"), found)
    rows = [(r.position, r.number, r.title, r.rows) for r in status.orderBy("position").collect()]
    assert rows == [(1, "9.1", "9.1.每日 total", 2), (2, "10", "10.late", 1), (3, "", "plain", 1)]
    totals = csvout.read_csv(spark, str(tmp_path / "out" / "9.1.每日 total")).collect()
    assert [tuple(r) for r in totals] == [("G61", "12"), ("P94", "1")]


def test_a_damaged_workbook_does_not_stop_the_others(spark, inbox, tmp_path):
    folder = inbox / "_sheet=RT_PR_HH24" / "_file=daily-20260401.xlsx"
    folder.mkdir()
    (folder / "part-0.json.gz").write_bytes(b"this is no gzip file")
    with pytest.raises(landing.LandingFailed, match="daily-20260401.xlsx") as failed:
        landing.land(spark, str(inbox), str(tmp_path / "lake"))
    assert len(failed.value.failures) == 1
    assert {(r._sheet, r._dt) for r in landing.landed_days(spark, str(tmp_path / "lake")).collect()} == {
        ("MON_LOG", "20260403"), ("RT_PR_HH24", "20260402"), ("RT_PR_HH24", "20260403")}


def test_nothing_is_lost_on_landing(spark, tmp_path):
    inbox, target = tmp_path / "inbox", str(tmp_path / "lake")
    put(inbox, "RT_PR_HH24", "daily-20260402.xlsx", {" PR_ID ": "G61", "CALTM": "0401 09", "CNT": "4 rows", "": "note", "EXTRA": 7.0},
        {"PR_ID": "P94", "CNT": 3.0, "AVG_TM": "0.5"}, {"PR_ID": "  ", "EXTRA": None})
    (inbox / "_sheet=RT_PR_HH24" / "_file=daily-20260402.xlsx" / "part-1.json").write_text('{"PR_ID": "cut off', encoding="utf-8")
    put(inbox, "MON_LOG", "daily-20260402.xlsx", {"TARGET_PORT": 8080.0, "MONITOR_KIND": "SERVER"})
    put(inbox, "BT_CNT", "daily-20260402.xlsx", {"JOB": "a", "N": 2.0})
    put(inbox, "ERR_LOG", "daily-20260402.xlsx", {"TEXT": "boom"})
    landing.land(spark, str(inbox), target, ingest_ts=5)
    rows = spark.read.parquet(f"{target}/_sheet=RT_PR_HH24").orderBy("PR_ID").collect()
    assert [(r.PR_ID, r.CALTM, r.CNT, r.AVG_TM, r.column_3, r.EXTRA) for r in rows] == [
        ("G61", "0401 09", None, None, "note", "7"), ("P94", None, 3, 0.5, None, None)]
    bad = {(r._sheet, r._dt, r.header, r.content) for r in landing.rejected_cells(spark, target).collect()}
    assert bad == {("RT_PR_HH24", "20260402", "CNT", "4 rows"), ("RT_PR_HH24", "20260402", None, '{"PR_ID": "cut off')}
    log = {r._sheet: (r._dt, r._file, r.row_count, r.rejected, r._ingest_ts) for r in landing.landing_log(spark, target).collect()}
    assert log["RT_PR_HH24"] == ("20260402", "daily-20260402.xlsx", 2, 2, 5) and set(log) == {"RT_PR_HH24", "MON_LOG", "BT_CNT", "ERR_LOG"}
    assert lake.read_sheet(spark, target, "MON_LOG").collect()[0].target_port == "8080"
    assert spark.read.parquet(f"{target}/_sheet=BT_CNT").collect()[0].N == "2"


def test_undeclared_columns_are_read(spark, tmp_path):
    """Columns and sheets without declared types open with the type that holds all their values."""
    inbox, target = tmp_path / "inbox", str(tmp_path / "lake")
    put(inbox, "RT_PR_HH24", "daily-20260402.xlsx", {**hour("G61", "0401 09", 0.5, 4.0), "EXTRA": 7.0, "cnt ": 5.0, "tx_cnt": "own", "_dt": "x"})
    put(inbox, "RT_PR_HH24", "daily-20260403.xlsx", {**hour("P94", "0402 09", 0.5, 4.0), "extra": "seven"})
    put(inbox, "ERR_LOG", "daily-20260402.xlsx", {"TEXT": "boom", "AT": "2026-04-02", "N": 1.0, "OK": True, "NONE": None},
        {"TEXT": "bang", "AT": "2026-04-02T10:00:00", "N": 1.5, "OK": False, "DEEP": {"a": 1}})
    landing.land(spark, str(inbox), target, ingest_ts=1)
    put(inbox, "ERR_LOG", "daily-20260403.xlsx", {"TEXT": "late", "N": 2.0, "MORE": 12345678901.0})
    landing.land(spark, str(inbox), target, ingest_ts=2)
    ws = Workspace.open(spark, target)
    hours = ws.get("rt_pr_hh24")
    assert [(r.pr_id, r.cnt, r.EXTRA, r.tx_cnt, r._dt, r._dt_cell) for r in hours.orderBy("pr_id").collect()] == [
        ("G61", 5, "7", "own", "20260402", "x"), ("P94", 4, "seven", None, "20260403", None)]
    assert ws.get("rt_pr_hh24_clean").filter("tx_cnt = 5").count() == 1  # extra columns don't disturb the datasets
    log = ws.get("err_log")
    assert {f.name: f.dataType.simpleString() for f in log.schema if not f.name.startswith("_")} == {
        "TEXT": "string", "AT": "timestamp_ntz", "N": "double", "OK": "boolean", "NONE": "string", "DEEP": "string", "MORE": "bigint"}
    rows = {r.TEXT: (r.AT, r.N, r.OK, r.DEEP, r.MORE) for r in log.collect()}
    assert rows == {"boom": (dt.datetime(2026, 4, 2), 1.0, True, None, None), "bang": (dt.datetime(2026, 4, 2, 10), 1.5, False, '{"a":1}', None),
                    "late": (None, 2.0, None, None, 12345678901)}
    # a day landed again forgets the columns it had before
    part = inbox / "_sheet=ERR_LOG" / "_file=daily-20260403.xlsx" / "part-0.json"
    part.write_text(json.dumps({"TEXT": "late", "N": "many"}), encoding="utf-8")
    landing.land(spark, str(inbox), target, date="20260403", force=True, ingest_ts=2)
    log = Workspace.open(spark, target).get("err_log")
    assert "MORE" not in log.columns and dict(log.dtypes)["N"] == "string"


def test_a_line_is_parsed_once(spark, inbox):
    """One parse of each line, and the columns come from the staged cells without evaluating a cell's expression twice."""
    root = f"{inbox}/_sheet=RT_PR_HH24"
    plan = landing.decoded(spark, [f"{root}/_file=daily-20260402.xlsx"], root)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("try_variant_get(") == 2
    rows = landing.staged(spark, str(inbox), "RT_PR_HH24", [f"{root}/_file=daily-20260402.xlsx"], landing.FILE_PATTERN)
    typed = landing.typed_cells(landing.cell_schema("RT_PR_HH24"), lake.header_schema(landing.SHEET_COLUMNS["RT_PR_HH24"]))
    headers = {name.lower(): name for name, _, _ in landing.SHEET_COLUMNS["RT_PR_HH24"]}
    plan = landing.landed_rows(rows, headers, typed, "RT_PR_HH24", 1)._jdf.queryExecution().executedPlan().toString()
    assert "from_json(" not in plan and all(plan.count(f", {key},") == 1 or plan.count(f"[{key}]") == 1 for key in headers)


def test_force_clears_an_emptied_day(spark, inbox, tmp_path):
    target = str(tmp_path / "lake")
    landing.land(spark, str(inbox), target, ingest_ts=1)
    part = inbox / "_sheet=RT_PR_HH24" / "_file=daily-20260402.xlsx" / "part-0.json"
    part.write_text(json.dumps({"PR_ID": " "}), encoding="utf-8")
    landing.land(spark, str(inbox), target, force=True, ingest_ts=2)
    assert {r._dt for r in lake.read_sheet(spark, target, "RT_PR_HH24").collect()} == {"20260403"}


def test_of_two_workbooks_of_a_day_the_first_lands(spark, inbox, tmp_path):
    put(inbox, "RT_PR_HH24", "again-20260402.xlsx", hour("P94", "0401 11", 1.0, 1.0))
    found = outcomes(landing.land(spark, str(inbox), str(tmp_path / "lake")))
    assert found["again-20260402.xlsx"] == (1, True) and found["daily-20260402.xlsx"] == (0, False)
    rows = lake.read_sheet(spark, str(tmp_path / "lake"), "RT_PR_HH24").filter("_dt = '20260402'").collect()
    assert {r._file for r in rows} == {"again-20260402.xlsx"}


def test_exports(spark, workspace, tmp_path):
    status = exports.run_exports(workspace, str(tmp_path / "out"), str(tmp_path / "work"))
    found = {r.file_name: (r.rows_written, r.is_empty) for r in status.collect()}
    assert found == {"daily_data": (1, False), "hourly_data": (1, False), "jvm_daily_data": (0, True), "jvm_hourly_data": (0, True)}
    assert not (tmp_path / "out" / "jvm_daily_data").exists()
    assert {(r.total_rows, r.truncated) for r in status.collect()} == {(1, False), (0, False)}
    row = csvout.read_csv(spark, str(tmp_path / "out" / "daily_data")).collect()[0]
    assert (row.application, row.max_cpu_rate, row.avg_used_mem, row.log_date) == ("app", "12.50", "6.0", "2026-04-01")


def test_task_files_and_row_limits(spark, workspace, tmp_path):
    path = tmp_path / "tasks.json"
    path.write_text(json.dumps({"db_path": "x", "tasks": [
        {"view": "v_prod_monitor_daily_count", "filename": "a", "type": "DAILY", "max_rows": None},
        {"view": "monitor_hourly", "filename": "b", "type": " hourly "}]}, indent=1), encoding="utf-8")
    assert exports.read_tasks(spark, str(path)) == (
        exports.ExportTask("monitor_daily", "a", "daily", None), exports.ExportTask("monitor_hourly", "b", "hourly", 10_000))
    path.write_text('{"tasks": [{"view": "v", "filename": "a", "type": "weekly"}]}', encoding="utf-8")
    with pytest.raises(ValueError, match="weekly"):
        exports.read_tasks(spark, str(path))
    tasks = (exports.ExportTask("monitor_daily", "cut", "daily", 0),)
    row = exports.run_exports(workspace, str(tmp_path / "cut"), str(tmp_path / "cut-work"), tasks).first()
    assert (row.rows_written, row.total_rows, row.truncated) == (0, 1, True)


def test_of_two_extracts_to_one_file_the_last_stays(spark, workspace, tmp_path):
    tasks = (exports.ExportTask("monitor_hourly", "same", "hourly"), exports.ExportTask("monitor_daily", "same", "daily"))
    status = exports.run_exports(workspace, str(tmp_path / "out"), str(tmp_path / "work"), tasks).collect()
    assert [(r.dataset, r.rows_written) for r in status] == [("monitor_hourly", 1), ("monitor_daily", 1)]
    daily = exports.run_exports(workspace, str(tmp_path / "alone"), str(tmp_path / "alone-work"), tasks[1:])
    assert daily.count() == 1
    found, expected = (csvout.read_csv(spark, str(tmp_path / folder / "same")) for folder in ("out", "alone"))
    assert found.columns == expected.columns and found.collect() == expected.collect()


def test_a_damaged_file_fails_its_report_only(spark, workspace, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.json.gz").write_bytes(b"this is no gzip file")

    def damaged(ws, params):
        return ws.spark.read.schema("pr_id string").json(str(bad))

    plan = [Report("1", "1.damaged", damaged, ("pr_id",)), Report("2", "2.sound", volume_of_month, ("pr_id",))]
    with pytest.raises(batch.ReportRunFailed) as finished:
        batch.run_reports(workspace, ReportParams.resolve(target_month="2026-04"), str(tmp_path / "c"), plan, continue_on_error=True)
    assert [(r.number, r.ok) for r in finished.value.status.orderBy("position").collect()] == [("1", False), ("2", True)]


HEAP = "usedHeapMem:1.00,maxHeapMem:2.00,usedMemRate:50%"


@pytest.mark.parametrize("late", ["", HEAP])
def test_export_days_follow_the_last_sample(spark, tmp_path, late):
    """The newest rows lack the metric (``late`` empty): the window ends where samples do."""
    def row(day, body, filed, port="1"):
        return ("JVM", "h", port, body, f"{day} 10:00:00", "f", "MON_LOG", filed, 0)

    rows = [row("2026-03-01", HEAP, "20260302"), row("2026-03-20", HEAP, "20260321"), row("2026-03-28", HEAP, "20260329"),
            row("2026-04-02", HEAP, "20260403"), row("2026-04-02", late, "20260404"), row("not a time", HEAP, "20260404", "2")]
    log = spark.createDataFrame(rows, "monitor_kind string, target_ip string, target_port string, mon_content string, "
                                      "createtime string, _file string, _sheet string, _dt string, _ingest_ts long")
    registry = spark.createDataFrame([], "application string, ipaddr string, port long")
    ws = Workspace(spark, {"mon_log": log, "registry": registry})
    rollups = exports.write_rollups(ws, str(tmp_path / "work"))
    for name in ("monitor_daily_jvm", "monitor_hourly_jvm"):
        kind = "hourly" if "hourly" in name else "daily"
        assert exports.export_rows(rollups[name], kind).collect() == exports.export_rows(ws.get(name), kind).collect()
    found = exports.export_rows(rollups["monitor_daily_jvm"], "daily").collect()
    assert [str(r.log_date)[:10] for r in found] == (["2026-04-02", "2026-03-28"] if late else ["2026-03-28", "2026-03-20"])
    assert exports.export_rows(rollups["monitor_daily"], "daily").count() == 0


def test_the_log_index_is_recorded_on_landing(spark, tmp_path, monkeypatch):
    inbox, target = tmp_path / "inbox", str(tmp_path / "lake")

    def sample(kind, time, host="h"):
        return {"MONITOR_KIND": kind, "TARGET_IP": host, "TARGET_PORT": "1", "CREATETIME": time, "MON_CONTENT": "usedCPURate:1.00%"}

    put(inbox, "MON_LOG", "daily-20260402.xlsx", sample("SERVER", "2026-03-30 10:00:00"), sample("SERVER", "2026-04-01 10:00:00"),
        sample("JVM", "no time"), sample("JVM", "2026-04-02 10:00:00", ""), sample("DB_CONN", "2026-04-02 10:00:00"))
    put(inbox, "MON_LOG", "daily-20260403.xlsx", sample("DB_CONN", "2026-04-02 10:00:00"))
    landing.land(spark, str(inbox), target, date="20260402")
    landing.land(spark, str(inbox), target)
    ws = Workspace.open(spark, target)
    scanned = sorted(tuple(r) for r in clean.log_days(ws.get("mon_log")).collect())
    monkeypatch.setattr(clean, "log_days", lambda sheet: pytest.fail("the log was read"))
    assert sorted(tuple(r) for r in ws.log_index()) == scanned == [
        ("20260402", "JVM", None, None), ("20260402", "SERVER", dt.date(2026, 3, 30), dt.date(2026, 4, 1))]
    monkeypatch.undo()
    # a day without a record is looked through
    more = lake.read_sheet(spark, target, "MON_LOG").filter("_dt = '20260402'").withColumns(
        {"_dt": F.lit("20260405"), "createtime": F.lit("2026-04-04 10:00:00")})
    back = {name: header for header, name, _ in landing.SHEET_COLUMNS["MON_LOG"]}
    lake.write_days(more.withColumnsRenamed(back), target)
    found = {(r["_dt"], r["monitor_kind"], r["last"]) for r in Workspace.open(spark, target).log_index()}
    assert ("20260405", "SERVER", dt.date(2026, 4, 4)) in found and ("20260402", "SERVER", dt.date(2026, 4, 1)) in found


def test_an_extract_plans_its_rollup_once(spark, workspace):
    plan = exports.export(workspace, "monitor_daily", "daily")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "subquery" not in plan  # the log and the registry
    rows = exports.export(workspace, "monitor_daily", "daily").collect()
    assert rows == exports.export_rows(workspace.get("monitor_daily"), "daily").collect() and len(rows) == 1
    with pytest.raises(ValueError, match="weekly"):
        exports.export(workspace, "monitor_daily", "weekly")


def test_csv_bytes(spark, tmp_path):
    rows = [(1, 'a "b", c', None), (2, "", "x\ny")]
    frame = spark.createDataFrame(rows, "ym int, category string, name string")
    written = csvout.write_csv(frame, str(tmp_path / "out"), LABELS["monthly_transaction_stats"], order=["ym"], bounded=True)
    text = next((tmp_path / "out").glob("part-*.csv")).read_text(encoding="utf-8")
    assert written == 2 and text == '﻿年月,類別,名稱\n1,"a ""b"", c",\n2,,"x\ny"\n'


def test_csv_stamps_show_a_fraction(spark, tmp_path):
    rows = [(dt.datetime(2026, 4, 1), dt.date(2026, 4, 1), 6.0), (dt.datetime(2026, 4, 1, 1, 2, 3, 40000), None, None)]
    frame = spark.createDataFrame(rows, "t timestamp_ntz, d date, f double")
    csvout.write_csv(frame, str(tmp_path / "out"), order=["t"], bounded=True, bom=False)
    text = next((tmp_path / "out").glob("part-*.csv")).read_text(encoding="utf-8")
    assert text == "t,d,f\n2026-04-01 00:00:00.0,2026-04-01,6.0\n2026-04-01 01:02:03.04,,\n"


def test_preview(spark):
    frame = spark.range(30).toDF("n")
    rows = csvout.preview(frame, 3, ["n"]).collect()
    assert [tuple(r) for r in rows] == [(0, 30, True), (1, 30, True), (2, 30, True)]
    assert csvout.preview(frame, 30).collect()[0].truncated is False
    pairs = spark.createDataFrame([(1, "b"), (1, "a"), (0, None)], "n int, s string").repartition(3)
    assert [tuple(r) for r in csvout.preview(pairs, 2, ["n"]).collect()] == [(0, None, 3, True), (1, "a", 3, True)]
    assert csvout.preview(pairs.filter("n > 5"), 2).collect() == []
    runs = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    csvout.preview(frame.mapInArrow(counting, "n long"), 3, ["n"]).collect()
    assert runs.value == 30  # every row passes once


def test_dimensions(spark, tmp_path):
    path = tmp_path / "cfg.csv"
    path.write_text("a;b\n1;x,y\n", encoding="utf-8")
    found = lake.read_delimited(spark, str(path))
    assert found.columns == ["a", "b"] and tuple(found.collect()[0]) == ("1", "x,y")
