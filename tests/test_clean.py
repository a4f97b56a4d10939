"""Edge rows of the clean layer."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import calendar, numbers, text
from tallyworks.operators.dedup import keep_latest
from tallyworks.plans import clean, monitor

D = dt.date
RT_CNT = ("caldy string, pr_id string, total_cnt long, ok_cnt long, fail_cnt long, rev_ok_cnt long, "
          "timeout_cnt long, other_err_cnt long, first_tx_raw string, last_tx_raw string, "
          "_file string, _sheet string, _dt string, _ingest_ts long")
RT_TMSPT = "pr_id string, caldy string, avg_tm double, _file string, _sheet string, _dt string, _ingest_ts long"
RT_PR = "pr_id string, caltm string, avg_tm double, cnt long, _file string, _sheet string, _dt string, _ingest_ts long"
MON = ("monitor_kind string, target_ip string, target_port string, mon_content string, createtime string, "
       "_file string, _sheet string, _dt string, _ingest_ts long")


def cnt_row(caldy, dt_, total=10, pr_id="A", file="f", first=None):
    return (caldy, pr_id, total, total, 0, 0, 0, 0, first, None, file, "RT_CNT", dt_, 0)


def dates(spark, *rows):
    frame = clean.rt_cnt_clean(spark.createDataFrame(list(rows), RT_CNT))
    return {(r.caldy, r._dt): r.tx_dt for r in frame.collect()}


@pytest.mark.parametrize("caldy, file_day, expected", [
    ("1231", "20260101", D(2025, 12, 31)),
    ("0401", "20260401", D(2026, 4, 1)),
    ("0229", "20240301", D(2024, 2, 29)),
    ("0229", "20250105", None),
    ("0301", "20240229", D(2023, 3, 1)),
    ("AB12", "20260401", None),
    ("1305", "20260401", None),
    ("", "20260401", None),
    (None, "20260401", None),
    (" 105", "20260401", D(2026, 1, 5)),
])
def test_date_from_key(spark, caldy, file_day, expected):
    assert dates(spark, cnt_row(caldy, file_day)) == {(caldy, file_day): expected}


def test_malformed_file_date_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)cast|invalid"):
        dates(spark, cnt_row("0101", "2026AB01"))


def test_first_transaction_time_wins_over_the_key(spark):
    rows = [cnt_row("0401", "20260402", pr_id="A", first="2026-03-31T23:59:59.5"),
            cnt_row("0401", "20260402", pr_id="B", first="2026-03-31"),
            cnt_row("0401", "20260402", pr_id="C", first="2026-03-31T23:59:59")]
    frame = clean.rt_cnt_clean(spark.createDataFrame(rows, RT_CNT))
    found = {r.pr_id: (r.tx_dt, r.caldy_match_txdt) for r in frame.collect()}
    assert found == {"A": (D(2026, 3, 31), False), "B": (D(2026, 4, 1), True), "C": (D(2026, 4, 1), True)}


def test_restated_rows_keep_the_newest(spark):
    rows = [cnt_row("0401", "20260402", 1, file="a"), cnt_row("0401", "20260403", 2, file="a"),
            cnt_row("0401", "20260403", 3, file="b"), cnt_row(None, "20260402", 4), cnt_row("XX", "20260403", 5)]
    frame = clean.rt_cnt_clean(spark.createDataFrame(rows, RT_CNT))
    assert sorted((str(r.tx_dt), r.total_cnt) for r in frame.collect()) == [("2026-04-01", 3), ("None", 5)]


def test_undated_time_rows_drop_and_codes_stay(spark):
    rows = [("G61", "0401", 1.5, "f", "s", "20260402", 0), ("G61", "zz", 9.0, "f", "s", "20260402", 0)]
    sheet = spark.createDataFrame(rows, RT_TMSPT)
    found = clean.rt_tmspt_clean(sheet).collect()
    assert [(r.pr_id_norm, r.avg_tm_ms) for r in found] == [("G61", 1500.0)]
    assert clean.rt_tmspt_clean(sheet, pad_codes=True).collect()[0].pr_id_norm == "G0061"


def test_padded_codes(spark):
    codes = ["G61", "V6440", "A12345", "FAC2", "g61", "G", "", None]
    frame = spark.createDataFrame([(c,) for c in codes], "c string").select(text.padded_code(F.col("c")))
    assert [r[0] for r in frame.collect()] == ["G0061", "V6440", "A12345", "FAC2", "g61", "G", "", None]


def test_hour_text_beyond_the_day_moves_the_stamp(spark):
    rows = [(" A ", "0401 25", 1.0, 5, "f", "s", "20260402", 0), ("B", "0401", 1.0, 5, "f", "s", "20260402", 0)]
    found = {r.pr_id: (r.tx_hour, r.tx_hour_ts_str) for r in
             clean.rt_pr_hh24_clean(spark.createDataFrame(rows, RT_PR)).collect()}
    assert found == {"A": (25, "2026-04-02 01:00:00"), "B": (None, None)}


def test_random_keys_against_python(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(2000):
        day = D(2019, 1, 1) + dt.timedelta(days=rng.randrange(2500))
        rows.append((f"{rng.randrange(0, 14):02d}{rng.randrange(0, 33):02d}", day.strftime("%Y%m%d")))

    def expected(key, file_day):
        filed = dt.datetime.strptime(file_day, "%Y%m%d").date()
        try:
            guess = D(filed.year, int(key[:2]), int(key[2:]))
        except ValueError:
            return None
        if guess <= filed:
            return guess
        return D(guess.year - 1, 2, 28) if (guess.month, guess.day) == (2, 29) else guess.replace(year=guess.year - 1)

    frame = spark.createDataFrame(rows, "k string, d string")
    frame = frame.select("k", "d", calendar.date_from_key(F.col("k"), calendar.file_date(F.col("d"))).alias("t"))
    assert [r.t for r in frame.collect()] == [expected(k, d) for k, d in rows]


def test_date_range_reads_the_same_rows_as_filtering(spark):
    rows = []
    for i in range(900):
        day = D(2024, 1, 1) + dt.timedelta(days=i)
        rows.append(("A", day.strftime("%m%d 05"), 1.0, i, "f", "s", (day + dt.timedelta(days=i % 300)).strftime("%Y%m%d"), 0))
    sheet = spark.createDataFrame(rows, RT_PR)
    whole = clean.within(clean.rt_pr_hh24_clean(sheet), "2024-02-28", "2025-03-01")
    pruned = clean.rt_pr_hh24_clean(sheet, "2024-02-28", "2025-03-01")
    assert sorted(whole.collect()) == sorted(pruned.collect()) and pruned.count() > 300


def test_keep_latest_with_a_hot_key_against_python(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}", f"2026{rng.randrange(1, 13):02d}01",
             f"f{rng.randrange(3)}", rng.randrange(50)) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "k string, _dt string, _file string, v int").repartition(7)
    best = {}
    for k, day, file, v in rows:
        best[k] = max(best.get(k, ("", "", -1)), (day, file, v))
    found = {r.k: (r._dt, r._file, r.v) for r in keep_latest(frame, ["k"], ["v"]).collect()}
    assert found == best


def log(spark, *rows):
    full = [(kind, ip, port, body, time, f"f{i}", "MON_LOG", "20260402", 0)
            for i, (kind, ip, port, body, time) in enumerate(rows)]
    return spark.createDataFrame(full, MON)


def test_metric_junk_gives_null(spark):
    bodies = ["usedCPURate:N/A%", "usedCPURate:", "usedCPURate:7.5GB", "usedCPURate:1234.5%", "x",
              "虛擬伺服器資源使用狀況-監控結果資訊：usedCPURate: 7.255%,totalMem:1e3"]
    rows = [("SERVER", f"10.0.0.{i}", "1", b, "2026-04-01 10:00:00") for i, b in enumerate(bodies)]
    found = clean.monitor_log(log(spark, *rows)).orderBy("target_ip").collect()
    assert [str(r.used_cpu_rate) for r in found] == ["None"] * 5 + ["7.26"]
    assert str(found[5].total_mem) == "1000.00"


def test_log_rows_without_host_or_kind_drop(spark):
    rows = [("SERVER", "", "1", "x", "t"), ("SERVER", None, "1", "x", "t"), (None, "h", "1", "x", "t"),
            ("DB_CONN", "h", "1", "dbConnStatus:OK, up", "not a time"), ("DB_CONN", "h", "2", "none", "2026-04-01")]
    found = clean.monitor_log(log(spark, *rows)).orderBy("target_port").collect()
    assert [(r.db_conn_status, r.log_createtime) for r in found] == [
        ("OK, up", None), ("", dt.datetime(2026, 4, 1))]


def test_ports_and_registry(spark):
    body = "usedHeapMem:1.00,maxHeapMem:2.00,usedMemRate:50%"
    parsed = clean.monitor_log(log(spark, ("JVM", "h", "08080", body, "2026-04-01 10:00:00"),
                                   ("JVM", "h", "8080", body, "2026-04-01 10:10:00"),
                                   ("JVM", "h", "none", body, "2026-04-01 10:20:00")))
    rows = [("one", "h", 8080), ("one", "h", 8080), ("two", "h", 8080)]
    registry = spark.createDataFrame(rows, "application string, ipaddr string, port long")
    daily = {(r.target_port, r.application, r.record_count) for r in monitor.monitor_daily_jvm(parsed, registry).collect()}
    assert daily == {("08080", "one", 1), ("08080", "two", 1), ("8080", "one", 1), ("8080", "two", 1), ("none", None, 1)}
    hourly = {(r.target_port, r.application) for r in monitor.monitor_hourly_jvm(parsed, registry).collect()}
    assert hourly == {("08080", None), ("8080", "one"), ("8080", "two"), ("none", None)}


def test_day_rollup_from_hour_states_is_the_direct_rollup(spark):
    rng = random.Random(5)
    rows = [("SERVER", f"h{rng.randrange(3)}", "1", f"usedCPURate:{rng.randrange(100)}.{rng.randrange(100):02d}%,totalMem:9.99,"
             f"freeMem:{rng.randrange(9)}.5", f"2026-04-0{rng.randrange(1, 4)} {rng.randrange(24):02d}:{i % 60:02d}:{i // 60:02d}")
            for i in range(600)]
    parsed = clean.monitor_log(log(spark, *rows))
    registry = spark.createDataFrame([("a", "h1", 1)], "application string, ipaddr string, port long")
    merged = monitor.finish_hosts(monitor.host_days(monitor.host_states(monitor.server_samples(parsed), hourly=True)), registry)
    assert sorted(map(str, merged.collect())) == sorted(map(str, monitor.monitor_daily(parsed, registry).collect()))


def test_rounding_follows_the_binary_value(spark):
    values = [1.005, 2.675, -2.5, 0.125, 1e9 + 0.005]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select(numbers.round_scaled(F.col("v")))
    assert [r[0] for r in frame.collect()] == [1.0, 2.68, -2.5, 0.13, 1000000000.01]
