"""Datasets kept up to date by what a landing changed.

A kept dataset is a table of the latest version of each key, in folders by month. A refresh looks at the days landed since the last one:

* days that are new are cleaned and merged with the stored months that their rows belong to;
* for days that were landed again, whose earlier rows may have been the latest ones, the months that the day had or has rows in are made anew from
  the landed days that hold rows of these months, as an index of days and months tells.

Only those months are read and replaced. Rollups follow: the groups of a replaced month are recomputed, for sums could be taken
back, but not peaks and numbers of days; all others stay. A refresh first writes its months aside and notes them; one that is lost while it
replaces months is completed by the next.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.dedup import keep_latest
from tallyworks.plans import clean, rollups
from tallyworks.plans.workspace import Workspace
from tallyworks.session import at_once
from tallyworks.sources.lake import LANDINGS, open_lake
from tallyworks.sources.listing import exists, folders, remove
from tallyworks.sources.schemas import CONTENT_PREFIXES, EXCLUDED_CODES

#: Tables are refreshed at the same time, but two appends to one folder would share their temporary files.
NOTING = threading.Lock()
#: Folder of rows without a date.
UNDATED = "none"
INDEX = "day string, months array<string>, run long"
NOTES = "dataset string, seq long, status string, mark long, months array<string>, path string"


@dataclass(frozen=True)
class Kept:
    """How a dataset's versions are told apart; ``ties`` are given over its clean rows."""

    sheet: str
    keys: Sequence[str]
    ties: Callable[[], list]
    date: str = "tx_dt"
    newest: tuple[str, str] = ("_dt", "_file")


KEPT = {
    "rt_cnt_clean": Kept("rt_cnt", ("tx_dt", "pr_id"), lambda: ["total_cnt", "ok_cnt", "fail_cnt", "timeout_cnt"]),
    "rt_tmspt_clean": Kept("rt_tmspt", ("tx_dt", "pr_id"), lambda: ["avg_tm_sec"]),
    "rt_pr_hh24_clean": Kept("rt_pr_hh24", ("tx_dt", "pr_id", "tx_hour"), lambda: ["tx_cnt", "avg_tm_sec"]),
    "monitor_log": Kept("mon_log", ("log_createtime", "target_ip", "target_port", "monitor_kind"),
                        lambda: [F.desc(F.xxhash64("log_content"))], "log_createtime", ("report_dt", "source_file")),
}
#: Rollups and the kept datasets whose changes they follow.
ROLLUPS = {
    "rt_cnt_daily": ("rt_cnt_clean",), "rt_cnt_weekly": ("rt_cnt_clean",), "rt_cnt_monthly": ("rt_cnt_clean",),
    "rt_cnt_monthly_without": ("rt_cnt_clean",), "rt_cnt_daily_with_tmspt": ("rt_cnt_clean", "rt_tmspt_clean"),
}


def month_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def shifted(month: str, by: int) -> str:
    """The month some months later."""
    if month == UNDATED:
        return month
    count = int(month[:4]) * 12 + int(month[5:]) - 1 + by
    return f"{count // 12:04d}-{count % 12 + 1:02d}"


@dataclass
class Store:
    """Kept datasets of a lake below ``root``."""

    spark: SparkSession
    lake: str
    root: str
    fmt: str = "parquet"
    prefixes: Sequence[str] = CONTENT_PREFIXES
    excluded_codes: Sequence[str] = EXCLUDED_CODES

    def refresh(self, datasets: Sequence[str] = tuple(KEPT), followers: Sequence[str] = tuple(ROLLUPS)) -> dict[str, list[str]]:
        """Bring datasets and the rollups that follow them up to date; returns the months that were replaced in each."""
        sheets = open_lake(self.spark, self.lake, self.fmt)
        kept = [name for name in datasets if KEPT[name].sheet in sheets]
        done = dict(zip(kept, at_once(self.spark, lambda name: self._refresh(name, sheets), kept)))
        follow = [name for name in followers if all(map(self.has, ROLLUPS[name])) and any(source in done for source in ROLLUPS[name])]
        return done | dict(zip(follow, at_once(self.spark, lambda name: self._follow(name, ROLLUPS[name]), follow)))

    def has(self, name: str) -> bool:
        return exists(self.spark, f"{self.root}/{name}")

    def table(self, name: str, months: Sequence[str] | None = None) -> DataFrame:
        """A kept table with its ``_month``: all of it, or the folders of some months only."""
        path = f"{self.root}/{name}"
        if months is None:
            return self.spark.read.parquet(path)
        held = {month for (month,) in folders(self.spark, path, "_month")}
        paths = [f"{path}/_month={month}" for month in sorted(set(months) & held)]
        reader = self.spark.read.option("basePath", path)
        return reader.parquet(*paths) if paths else self.spark.read.parquet(path).filter(F.lit(False))

    def get(self, name: str, first=None, last=None) -> DataFrame:
        """A dataset or rollup as the full run gives it, or its months from ``first`` to ``last`` ('yyyy-MM')."""
        rows = self.table(name).filter(F.col("_month").between(first or "", last or "~"))
        return rows.drop("_month")

    def workspace(self, **frames: DataFrame) -> Workspace:
        """A workspace over the kept tables and the lake's other sheets."""
        names = [n for n in (*KEPT, *ROLLUPS) if self.has(n)]
        own = {n: self.table(n).drop("_month") for n in names}
        ws = Workspace(self.spark, {**open_lake(self.spark, self.lake, self.fmt), **own, **frames},
                       prefixes=self.prefixes, excluded_codes=self.excluded_codes)
        ws.by_month, ws.lake = {n: self.table(n) for n in names}, self.lake
        return ws

    # ---------------------------------------------------------------- latest versions

    def _versions(self, name: str, sheet: DataFrame) -> DataFrame:
        """All versions of a sheet's clean rows, with their month."""
        options = {"prefixes": self.prefixes} if name == "monitor_log" else {}
        rows = getattr(clean, name)(sheet, all_versions=True, **options)
        return rows.withColumn("_month", month_of(F.col(KEPT[name].date)))

    def _latest(self, name: str, rows: DataFrame) -> DataFrame:
        return keep_latest(rows, KEPT[name].keys, KEPT[name].ties(), KEPT[name].newest)

    def _landings(self, sheet: str) -> DataFrame:
        log = self.spark.read.schema(LANDINGS).parquet(f"{self.lake}/_landings")
        return log.filter(F.col("_sheet") == sheet.upper()).groupBy("_dt").agg(F.min("_run").alias("first"), F.max("_run").alias("last"))

    def _refresh(self, name: str, sheets: dict[str, DataFrame]) -> list[str]:
        mark = self._complete(name)
        sheet, day = sheets[KEPT[name].sheet], KEPT[name].newest[0]
        # one row per day landed since the last refresh
        changed = self._landings(KEPT[name].sheet).filter(F.coalesce("last", F.lit(1)) > mark).collect()
        if not changed:
            return []
        fresh = self._versions(name, sheet if not mark else sheet.filter(F.col("_dt").isin([c["_dt"] for c in changed])))
        new_mark = max(c["last"] or 1 for c in changed)
        index = fresh.groupBy(F.col(day).alias("day")).agg(F.sort_array(F.collect_set("_month")).alias("months"))
        index = index.withColumn("run", F.lit(new_mark).cast("long"))
        again = [c["_dt"] for c in changed if mark and (c["first"] or 1) <= mark]
        if not mark:
            rows, months = fresh, None
        else:
            gone = self.spark.createDataFrame([(d, [], new_mark) for d in again], INDEX)
            before = self._index(name)
            had = {m for r in before.filter(F.col("day").isin(again)).collect() for m in r["months"]} if again else set()
            months = sorted(had | {r["m"] for r in index.select(F.explode("months").alias("m")).distinct().collect()})
            index = index.unionAll(gone.join(index.select("day"), "day", "left_anti").select("day", "months", "run"))
            if again:
                others = before.filter(F.arrays_overlap("months", F.array(*map(F.lit, months)).cast("array<string>")) & ~F.col("day").isin([c["_dt"] for c in changed]))
                days = [r["day"] for r in others.select("day").collect()]  # landed days that hold rows of these months
                rows = fresh.unionByName(self._versions(name, sheet.filter(F.col("_dt").isin(days)))).filter(F.col("_month").isin(months))
            else:
                rows = self.table(name, months).unionByName(fresh)
        index.coalesce(1).write.mode("append").parquet(f"{self.root}/_index/{name}")
        return self._replace(name, self._latest(name, rows), months, new_mark)

    def _index(self, name: str) -> DataFrame:
        """Months that each landed day has rows in."""
        rows = self.spark.read.schema(INDEX).parquet(f"{self.root}/_index/{name}")
        return rows.groupBy("day").agg(F.max_by("months", "run").alias("months"))

    # ---------------------------------------------------------------- replacing months

    def _replace(self, name: str, rows: DataFrame, months: Sequence[str] | None, mark: int) -> list[str]:
        """Write months aside, note them, put them in place. ``months`` that have no rows any more go."""
        path = f"{self.root}/_aside/{name}-{uuid.uuid4().hex}"
        rows.hint("rebalance", F.col("_month")).write.partitionBy("_month").parquet(path)
        made = [month for (month,) in folders(self.spark, path, "_month")]
        self._note(name, "aside", mark, sorted(set(months or ()) | set(made)), path)
        self._complete(name)
        return sorted(set(months or ()) | set(made))

    def _complete(self, name: str) -> int:
        """Put the months noted last in place, if that was not done; returns the mark of the last refresh, 0 if there was none."""
        notes = self._notes(name).orderBy(F.desc("seq")).limit(1).collect()
        if not notes:
            return 0
        note = notes[0]
        if note["status"] == "aside":
            made = {month for (month,) in folders(self.spark, note["path"], "_month")}
            rows = self.spark.read.parquet(note["path"])
            if "_month" not in rows.columns:  # nothing was left of these months
                rows = rows.withColumn("_month", F.lit(UNDATED)).filter(F.lit(False))
            rows = rows.withColumn("_month", F.col("_month").cast("string"))
            rows.hint("rebalance", F.col("_month")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "_month").parquet(f"{self.root}/{name}")
            for month in set(note["months"]) - made:
                remove(self.spark, f"{self.root}/{name}/_month={month}")
            self._note(name, "done", note["mark"], note["months"], note["path"])
            remove(self.spark, note["path"])
        return note["mark"]

    def _notes(self, name: str) -> DataFrame:
        if not exists(self.spark, f"{self.root}/_notes"):
            return self.spark.createDataFrame([], NOTES)
        return self.spark.read.schema(NOTES).parquet(f"{self.root}/_notes").filter(F.col("dataset") == name)

    def _note(self, name: str, status: str, mark: int, months: Sequence[str], path: str) -> None:
        row = (name, time.time_ns(), status, mark, list(months), path)
        with NOTING:
            self.spark.createDataFrame([row], NOTES).coalesce(1).write.mode("append").parquet(f"{self.root}/_notes")

    # ---------------------------------------------------------------- rollups

    def _follow(self, name: str, sources: Sequence[str]) -> list[str]:
        """Recompute the groups of the months that changed in the sources since the rollup last did so."""
        mark = self._complete(name)
        notes = [r for source in sources for r in self._notes(source).filter((F.col("status") == "done") & (F.col("seq") > mark)).collect()]
        if not notes:
            return []
        months = sorted({month for note in notes for month in note["months"]})
        new_mark = max(note["seq"] for note in notes)
        if name == "rt_cnt_weekly":
            # a week belongs to the month it starts in, and may reach into the next
            months = sorted({shifted(m, by) for m in months for by in (-1, 0)})
            counts = self.table("rt_cnt_clean", sorted({shifted(m, by) for m in months for by in (0, 1)}))
            rows = rollups.rt_cnt_weekly(counts.drop("_month")).withColumn("_month", month_of(F.col("week_start")))
            # the months read beside them hold parts of other weeks only
            return self._replace(name, rows.filter(F.col("_month").isin(months)), months, new_mark)
        counts = self.table("rt_cnt_clean", months).drop("_month")
        if name == "rt_cnt_daily_with_tmspt":
            rows = rollups.rt_cnt_daily_with_tmspt(counts, self.table("rt_tmspt_clean", months).drop("_month"))
        elif name == "rt_cnt_monthly_without":
            rows = rollups.rt_cnt_monthly_without(counts, self.excluded_codes)
        else:
            rows = getattr(rollups, name)(counts)
        return self._replace(name, rows.withColumn("_month", F.coalesce("ym", F.lit(UNDATED))), months, new_mark)
