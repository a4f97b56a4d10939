from __future__ import annotations

import datetime as dt
import json

import pytest

from tallyworks.plans.params import ReportParams, months_between, run_query

resolve = ReportParams.resolve


def test_defaults_from_the_target_month():
    p = resolve(target_month="2026-03")
    assert (p.range_start_date, p.range_end_date) == ("2026-03-01", "2026-03-31")
    assert (p.range_start_time, p.range_end_time) == ("2026-03-01 00:00", "2026-03-31 23:59")
    assert (p.history_start_month, p.history_end_month) == ("2025-09", "2026-03")
    assert (p.previous_target_month, p.previous_range_end_time) == ("2026-02", "2026-02-28 23:59")


def test_leap_february_and_last_month():
    assert resolve(target_month="2028-02").range_end_date == "2028-02-29"
    assert resolve(today=dt.date(2026, 1, 15)).target_month == "2025-12"


def test_target_month_is_derived_in_order():
    assert resolve(range_end_date="2026-04-10", range_start_date="2026-03-01").target_month == "2026-04"
    assert resolve(range_start_date="2026-03-05").target_month == "2026-03"
    assert resolve(range_end_time="2026-05-02T10:30", range_start_time="2026-04-01 00:00").target_month == "2026-05"
    assert resolve(target_month="  ", range_start_time="2026-04-01 00:00").target_month == "2026-04"


@pytest.mark.parametrize("given, message", [
    ({"target_month": "2026/03"}, "targetMonth: .* is not of the form YYYY-MM"),
    ({"target_month": "2026-3"}, "targetMonth: .* is not of the form YYYY-MM"),
    ({"target_month": "2026-03", "range_start_date": "2026-04-01"}, "the date range ends on"),
    ({"target_month": "2026-03", "range_end_time": "2026-02-01 00:00"}, "the time range ends at"),
    ({"target_month": "2025-08"}, "the history ends before"),
    ({"target_month": "2026-03", "range_start_time": "yesterday"}, "rangeStartTime: .* is not of the form"),
])
def test_bad_parameters(given, message):
    with pytest.raises(ValueError, match=message):
        resolve(**given)


def test_months_between():
    assert months_between("2025-11", "2026-02") == ["2025-11", "2025-12", "2026-01", "2026-02"]


def test_parameters_are_bound_not_pasted(spark):
    p = resolve(target_month="2026-03")
    row = run_query(spark, "SELECT '${targetMonth}' AS a, ${rangeEndDate} AS b", p).collect()[0]
    assert (row.a, row.b) == ("2026-03", "2026-03-31")
    with pytest.raises(ValueError, match="the query names nope"):
        run_query(spark, "SELECT ${nope}", p)


def test_snapshot_holds_all_parameters():
    p = resolve(target_month="2026-03")
    assert json.loads(p.to_json())["previous_target_month"] == "2026-02" and len(p.named()) == 10
