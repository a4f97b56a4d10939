"""Kept datasets and rollups against full runs."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tallyworks.plans import incremental, rollups
from tallyworks.plans.incremental import Store
from tallyworks.plans.workspace import Workspace
from tallyworks.sources import landing

FOLLOWED = ("rt_cnt_clean", "rt_tmspt_clean", *incremental.ROLLUPS)


def count(code, caldy, total, first=None):
    return {"CALDY": caldy, "PR_ID": code, "總筆數": float(total), "成功": float(total), "失敗": 0.0, "TIMEOUT": 0.0, "首筆交易": first, "尾筆交易": None}


def put(root, sheet, day, *rows):
    folder = root / f"_sheet={sheet}" / f"_file=daily-{day}.xlsx"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.json").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def rows_of(df):
    return sorted((tuple(map(repr, r)) for r in df.select(*sorted(df.columns)).collect()))


def same_as_full(spark, store):
    ws = Workspace.open(spark, store.lake)
    for name in FOLLOWED:
        assert rows_of(store.get(name)) == rows_of(ws.get(name)), name


def times(root, name):
    return {p.name: max(f.stat().st_mtime_ns for f in p.glob("part-*")) for p in (root / name).glob("_month=*")}


def test_months_follow_their_workbooks(spark, tmp_path):
    inbox, store = tmp_path / "inbox", Store(spark, str(tmp_path / "lake"), str(tmp_path / "store"))

    def landed(day=None):
        landing.land(spark, str(inbox), store.lake, date=day, force=day is not None)
        return store.refresh(("rt_cnt_clean", "rt_tmspt_clean"))

    put(inbox, "RT_CNT", "20260131", count("A", "0130", 5), count("B", "0130", 7), count("A", "1231", 3))
    put(inbox, "RT_CNT", "20260301", count("A", "0227", 5, "2026-02-27T08:00:00.000000"), count("A", "0228", 9), count("C", "bad", 1))
    put(inbox, "RT_CNT", "20260415", count("A", "0410", 2), count("B", "0410", 4))
    put(inbox, "RT_TMSPT", "20260131", {"PR_ID": "A", "CALDY": "0130", "AVG_TM": 0.5})
    first = landed()
    assert first["rt_cnt_clean"] == ["2025-12", "2026-01", "2026-02", "2026-04", "none"]
    same_as_full(spark, store)
    before = {name: times(tmp_path / "store", name) for name in FOLLOWED}
    # a new workbook restates a day of February: no other month is read or written
    put(inbox, "RT_CNT", "20260302", count("A", "0228", 11), count("D", "0228", 1))
    second = landed()
    assert second["rt_cnt_clean"] == ["2026-02"] and second["rt_cnt_weekly"] == ["2026-01", "2026-02"]
    assert second["rt_cnt_monthly"] == second["rt_cnt_daily"] == ["2026-02"] and second["rt_tmspt_clean"] == []
    same_as_full(spark, store)
    after = {name: times(tmp_path / "store", name) for name in FOLLOWED}
    for name in FOLLOWED:
        changed = {m for m in after[name] if after[name][m] != before[name].get(m)}
        assert changed <= {f"_month={m}" for m in second[name]}, name
    assert all("_month=2026-02" in f for f in store.table("rt_cnt_clean", ["2026-02"]).inputFiles())
    # the winner is landed again without the row: the version before it counts again, and a month can become empty
    put(inbox, "RT_CNT", "20260302", count("D", "0228", 2))
    put(inbox, "RT_CNT", "20260415", count("B", "0110", 4))
    assert landed("20260302")["rt_cnt_clean"] == ["2026-02"]
    same_as_full(spark, store)
    assert landed("20260415")["rt_cnt_clean"] == ["2026-01", "2026-04"]
    same_as_full(spark, store)
    assert "_month=2026-04" not in times(tmp_path / "store", "rt_cnt_clean")
    # mean times alone change
    put(inbox, "RT_TMSPT", "20260301", {"PR_ID": "A", "CALDY": "0228", "AVG_TM": 0.25})
    third = landed()
    assert third["rt_cnt_clean"] == [] and third["rt_cnt_monthly"] == [] and third["rt_cnt_daily_with_tmspt"] == ["2026-02"]
    same_as_full(spark, store)
    assert landed() == {name: [] for name in third}
    # a range of dates comes from the kept months
    ws, full = store.workspace(), Workspace.open(spark, store.lake)
    span = (dt.date(2026, 2, 1), dt.date(2026, 2, 28))
    for name in ("rt_cnt_clean", "rt_cnt_daily", "rt_cnt_monthly", "rt_cnt_daily_with_tmspt", "rt_tmspt_clean"):
        assert rows_of(ws.between(name, *span)) == rows_of(full.between(name, *span)), name
    plan = ws.between("rt_cnt_monthly", *span)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "Window" not in plan  # no deduplication


def test_a_lost_refresh_is_completed(spark, tmp_path, monkeypatch):
    inbox, store = tmp_path / "inbox", Store(spark, str(tmp_path / "lake"), str(tmp_path / "store"))
    put(inbox, "RT_CNT", "20260131", count("A", "0130", 5))
    landing.land(spark, str(inbox), store.lake)
    store.refresh(("rt_cnt_clean",))
    put(inbox, "RT_CNT", "20260201", count("A", "0130", 6), count("B", "0131", 1))
    landing.land(spark, str(inbox), store.lake)
    note = Store._note

    def stop(self, name, status, *rest):
        note(self, name, status, *rest)
        if status == "aside":
            raise RuntimeError("lost")

    monkeypatch.setattr(Store, "_note", stop)
    with pytest.raises(RuntimeError):
        store.refresh(("rt_cnt_clean",))
    monkeypatch.undo()
    store.refresh(("rt_cnt_clean",))
    full = Workspace.open(spark, store.lake)
    assert rows_of(store.get("rt_cnt_clean")) == rows_of(full.get("rt_cnt_clean"))
    assert rows_of(store.get("rt_cnt_monthly")) == rows_of(rollups.rt_cnt_monthly(full.get("rt_cnt_clean")))


def test_log_and_hours(spark, tmp_path):
    inbox, store = tmp_path / "inbox", Store(spark, str(tmp_path / "lake"), str(tmp_path / "store"), prefixes=())

    def sample(time, cpu, host="h"):
        return {"MONITOR_KIND": "SERVER", "TARGET_IP": host, "TARGET_PORT": "1", "CREATETIME": time, "MON_CONTENT": f"usedCPURate:{cpu}%"}

    put(inbox, "MON_LOG", "20260401", sample("2026-03-31 10:00:00", "1.00"), sample("2026-04-01 10:00:00", "2.00"), sample("no time", "3.00"))
    put(inbox, "RT_PR_HH24", "20260401", {"PR_ID": "A ", "CALTM": "0331 09", "AVG_TM": 0.5, "CNT": 1.0})
    landing.land(spark, str(inbox), store.lake)
    store.refresh()
    put(inbox, "MON_LOG", "20260402", sample("2026-04-01 10:00:00", "4.00"), sample("2026-04-02 10:00:00", "5.00"))
    put(inbox, "RT_PR_HH24", "20260402", {"PR_ID": "A", "CALTM": "0331 09", "AVG_TM": 0.25, "CNT": 2.0}, {"PR_ID": "B", "CALTM": "0401 09", "AVG_TM": 0.25, "CNT": 2.0})
    landing.land(spark, str(inbox), store.lake)
    done = store.refresh()
    assert done["monitor_log"] == ["2026-04"] and done["rt_pr_hh24_clean"] == ["2026-03", "2026-04"]
    ws = Workspace.open(spark, store.lake, prefixes=())
    for name in ("monitor_log", "rt_pr_hh24_clean"):
        assert rows_of(store.get(name)) == rows_of(ws.get(name))
    span = (dt.date(2026, 4, 1), dt.date(2026, 4, 30))
    assert rows_of(store.workspace().hourly(*span)) == rows_of(ws.hourly(*span))
