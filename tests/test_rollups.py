"""Rollups, statistics and peaks on small tables."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

from tallyworks.plans import rollups, stats

D = dt.date
CLEAN = "tx_dt date, pr_id string, total_cnt long, ok_cnt long, fail_cnt long, timeout_cnt long"
HOURLY = "tx_dt date, tx_hour int, pr_id string, tx_cnt long, avg_tm_ms double"
CODES = "seq_no int, pr_id string, category string, name string"


def days(spark, *rows):
    return spark.createDataFrame([(d, c, n, n // 2, 0, 0) for d, c, n in rows], CLEAN)


def test_week_over_new_year_stays_split(spark):
    frame = rollups.rt_cnt_weekly(days(spark, (D(2024, 12, 30), "A", 10), (D(2025, 1, 2), "A", 4)))
    found = {(r.year, r.iso_yw, r.total_cnt, r.week_start, r.week_end) for r in frame.collect()}
    assert found == {("2024", "2025-01", 10, D(2024, 12, 30), D(2025, 1, 5)),
                     ("2025", "2025-01", 4, D(2024, 12, 30), D(2025, 1, 5))}


def test_peak_ties_go_to_the_earliest_day(spark):
    frame = rollups.rt_cnt_monthly(days(spark, (D(2026, 4, 9), "A", 7), (D(2026, 4, 3), "A", 7), (D(2026, 4, 5), "A", 1)))
    row = frame.collect()[0]
    assert (row.peak_day, row.peak_day_cnt, row.avg_per_month_day, row.data_days) == (D(2026, 4, 3), 7, 1, 3)


def test_zero_totals_have_no_rate(spark):
    row = rollups.rt_cnt_daily(days(spark, (D(2026, 4, 1), "A", 0))).collect()[0]
    assert row.ok_rate is None and row.weekday == "三"


def test_undated_rows_form_their_own_rollup_row(spark):
    rows = days(spark, (None, "A", 5), (D(2026, 4, 1), "A", 7))
    found = {(r.ym, r.data_days, r.total_cnt, r.avg_per_data_day, r.peak_day) for r in rollups.rt_cnt_monthly(rows).collect()}
    assert found == {(None, 0, 5, None, None), ("2026-04", 1, 7, 7, D(2026, 4, 1))}


def test_month_without_codes_counts_each_day_once(spark):
    rows = days(spark, (D(2026, 4, 1), "A", 5), (D(2026, 4, 1), "B", 6), (D(2026, 4, 2), "X", 99), (D(2026, 4, 2), None, 50))
    row = rollups.rt_cnt_monthly_without(rows, ["X"]).collect()[0]
    assert (row.data_days, row.total_cnt, row.peak_day_cnt, row.peak_day) == (1, 11, 6, D(2026, 4, 1))


def hours(spark, *rows):
    return spark.createDataFrame(list(rows), HOURLY)


def page(spark, rows, codes=(("A", "update", "name A"), ("B", "query", None))):
    dim = spark.createDataFrame([(i, *c) for i, c in enumerate(codes)], CODES)
    return {r.pr_id: r for r in stats.monthly_transaction_stats(hours(spark, *rows), dim).collect()}


def test_statistics_page(spark):
    found = page(spark, [
        (D(2026, 4, 1), 9, "A", 10, 100.0), (D(2026, 4, 1), 8, "A", 10, 300.0), (D(2026, 4, 2), 7, "A", 4, 200.0),
        (D(2026, 4, 3), 1, "B", 1, 50.0), (D(2026, 4, 3), 1, "C", 75, 1.0), (None, 1, "A", 1000, 1.0)])
    assert set(found) == {"A", "B"}
    row = found["A"]
    assert (row.total_cnt, row.active_days, row.avg_ms) == (24, 2, 200)
    assert (row.peak_day, row.peak_day_cnt) == ("115/04/01", 20)
    assert (row.peak_hour_range, row.peak_hour_cnt) == ("115/04/01 08:00~08:59", 10)
    assert (row.peak_ms_label, row.share) == ("115/04/01\n200", "24.0%")
    assert (row.first_date, row.last_date) == ("115/04/01", "115/04/02")
    assert found["B"].name == "未定義名稱" and found["B"].share == "1.0%"


def test_codes_listed_twice_multiply(spark):
    rows = [(D(2026, 4, 1), 9, "A", 10, 100.0)]
    dim = spark.createDataFrame([(1, "A", "update", "n1"), (2, "A", "update", "n2")], CODES)
    found = stats.monthly_transaction_stats(hours(spark, *rows), dim).collect()
    assert sorted((r.name, r.total_cnt, r.active_days, r.share) for r in found) == [
        ("n1", 20, 2, "200.0%"), ("n2", 20, 2, "200.0%")]


def test_missing_times_rank_last(spark):
    found = page(spark, [(D(2026, 4, 1), 9, "A", 50, None), (D(2026, 4, 2), 9, "A", 5, 1.0)])["A"]
    assert (found.peak_day, found.peak_day_cnt, found.avg_ms) == ("115/04/02", 5, 0)
    found = page(spark, [(D(2026, 4, 2), 9, "A", 50, None), (D(2026, 4, 1), 9, "A", 5, None)])["A"]
    assert (found.peak_day, found.avg_ms, found.peak_ms_label) == ("115/04/01", None, "115/04/01\n")


def test_random_hours_against_python(spark):
    rng = random.Random(11)
    rows = [(D(2026, rng.randrange(1, 4), rng.randrange(1, 28)), h, c, rng.randrange(1, 6), float(rng.randrange(1, 900)))
            for c in "AB" for h in range(24) for _ in range(6)]
    rows = list({(d, h, c): (d, h, c, n, m) for d, h, c, n, m in rows}.values())
    totals, by_day = defaultdict(int), defaultdict(list)
    for d, h, c, n, m in rows:
        totals[(d.month, c)] += n
        by_day[(d, c)].append((h, n, m))
    found = stats.code_frame(stats.monthly(stats.day_frame(hours(spark, *rows))), ["ym"]).collect()
    assert len(found) == len(totals)
    for r in found:
        month = int(r.ym[5:])
        mine = {d: v for (d, c), v in by_day.items() if c == r.pr_id and d.month == month}
        means = {d: sum(n * m for _, n, m in v) / sum(n for _, n, _ in v) for d, v in mine.items()}
        assert r.total_cnt == totals[(month, r.pr_id)]
        assert r.slow["day"] == min(means, key=lambda d: (-means[d], d))
        busiest = min((-n, d, h) for d, v in mine.items() for h, n, _ in v)
        assert (-r.busy["cnt"], r.busy["day"], r.busy["hour"]) == busiest
