"""SQL table functions over the transaction datasets: ``<sheet>_between(first DATE, last DATE)``.

``SELECT * FROM rt_pr_hh24_between(DATE'2026-04-01', DATE'2026-04-30')`` gives the rows that ``Workspace.between`` gives. The range is
applied to the versions of a row before the newest is kept, so a query reads only the landed days that can hold it. A NULL bound gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from tallyworks.plans import clean
from tallyworks.plans.incremental import KEPT
from tallyworks.plans.workspace import Workspace


@dataclass(frozen=True)
class Ranged:
    """``keyed`` datasets date their rows by key and file day, so that a range bounds the file days."""

    dataset: str
    sheet: str
    keyed: bool = True


RANGED = {
    "rt_cnt_between": Ranged("rt_cnt_clean", "rt_cnt", keyed=False),
    "rt_tmspt_between": Ranged("rt_tmspt_clean", "rt_tmspt"),
    "rt_pr_hh24_between": Ranged("rt_pr_hh24_clean", "rt_pr_hh24"),
    "rt_node_hh24_between": Ranged("rt_node_hh24_clean", "rt_node_hh24"),
}
#: Day rollups: a filter on their day passes through the aggregate and the dedup below it.
DAYS = {"rt_cnt_daily_between": "rt_cnt_daily", "rt_cnt_daily_with_tmspt_between": "rt_cnt_daily_with_tmspt"}

IN_RANGE = "tx_dt BETWEEN first AND last"
IN_FILES = (f"_dt BETWEEN date_format(first, 'yyyyMMdd') "
            f"AND date_format(date_add(last, {clean.MAX_FILE_LAG_DAYS}), 'yyyyMMdd')")
IN_MONTHS = "_month BETWEEN date_format(first, 'yyyy-MM') AND date_format(last, 'yyyy-MM')"


def _body(ws: Workspace, name: str) -> str:
    """The function's query, over a view registered for it."""
    if name in DAYS:
        ws.get(DAYS[name]).createOrReplaceTempView(f"{name}_rows")
        return f"SELECT * FROM {name}_rows WHERE CAST(tx_date AS DATE) BETWEEN first AND last"
    ranged, view = RANGED[name], f"{name}_rows"
    if ranged.dataset in ws.by_month:
        ws.by_month[ranged.dataset].createOrReplaceTempView(view)
        return f"SELECT * EXCEPT (_month) FROM {view} WHERE {IN_RANGE} AND {IN_MONTHS}"
    if ws.has(ranged.dataset):
        ws.get(ranged.dataset).createOrReplaceTempView(view)
        return f"SELECT * FROM {view} WHERE {IN_RANGE}"
    where = f"{IN_RANGE} AND {IN_FILES}" if ranged.keyed else IN_RANGE
    sheet, build = ws.get(ranged.sheet), getattr(clean, ranged.dataset)
    if ranged.dataset not in KEPT:
        build(sheet).createOrReplaceTempView(view)
        return f"SELECT * FROM {view} WHERE {where}"
    build(sheet, all_versions=True).createOrReplaceTempView(view)
    kept = KEPT[ranged.dataset]
    order = ", ".join(f"{column} DESC" for column in (*kept.newest, *kept.ties()))
    return (f"SELECT * EXCEPT (_rank) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(kept.keys)} ORDER BY {order}) AS _rank "
            f"FROM {view} WHERE {where}) WHERE _rank = 1")


def register(ws: Workspace, query: str | None = None) -> list[str]:
    """Load the functions that a query names, or all; those whose sheet has not landed are left out."""
    names = []
    for name in (*RANGED, *DAYS):
        if query is not None and not re.search(rf"\b{name}\b", query, re.IGNORECASE):
            continue
        try:
            body = _body(ws, name)
        except KeyError:
            continue
        ws.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(first DATE, last DATE) RETURNS TABLE RETURN {body}")
        names.append(name)
    return names
