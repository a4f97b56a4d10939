"""The datasets by name, each built from the landed sheets or read back once written."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyworks.plans import clean, monitor, rollups, stats
from tallyworks.sources.lake import log_spans, open_lake, read_codes, read_delimited, read_registry
from tallyworks.sources.listing import folders
from tallyworks.sources.schemas import CONTENT_PREFIXES, EXCLUDED_CODES

DATASETS = (
    "rt_cnt_clean", "rt_tmspt_clean", "rt_pr_hh24_clean", "rt_node_hh24_clean", "rt_cnt_daily",
    "rt_cnt_daily_with_tmspt", "rt_cnt_weekly", "rt_cnt_monthly", "rt_cnt_monthly_without",
    "monthly_transaction_stats", "monitor_log", "monitor_daily", "monitor_hourly",
    "monitor_daily_jvm", "monitor_hourly_jvm", "pr_info", "cfg_pr_info", "registry_info",
)
DATED = DATASETS[:10]  # those with transaction dates


class Workspace:
    """Sheets and dimensions (``rt_cnt``, ``rt_pr_hh24``, ``mon_log``, ``codes``,
    ``registry`` ...) plus any dataset already written, under its own name."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame], *,
                 prefixes: Sequence[str] = CONTENT_PREFIXES,
                 excluded_codes: Sequence[str] = EXCLUDED_CODES):
        self.spark = spark
        self.frames = dict(frames)
        #: The lake that the sheets are read from, if they are.
        self.lake: str | None = None
        #: Written tables with their ``_month``, for datasets that are kept by month.
        self.by_month: dict[str, DataFrame] = {}
        self.prefixes = prefixes
        self.excluded_codes = excluded_codes

    @classmethod
    def open(cls, spark: SparkSession, lake: str, codes: str | None = None, registry: str | None = None,
             cfg_codes: str | None = None, fmt: str = "parquet", **options) -> Workspace:
        frames = open_lake(spark, lake, fmt)
        if codes:
            frames["codes"] = read_codes(spark, codes)
        if registry:
            frames["registry"] = read_registry(spark, registry)
        if cfg_codes:
            frames["cfg_codes"] = read_delimited(spark, cfg_codes, typed=True)
        ws = cls(spark, frames, **options)
        ws.lake = lake
        return ws

    def has(self, name: str) -> bool:
        return name in self.frames

    def get(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        if name not in DATASETS:
            raise KeyError(f"no sheet, dimension or dataset named {name}")
        return getattr(self, f"_{name}")()

    def between(self, name: str, first: dt.date, last: dt.date) -> DataFrame:
        """A transaction dataset over the dates of a range.

        Datasets dated by the file's day and key read only the landed days that can hold the range. The day
        counts (``rt_cnt_clean`` and its rollups) take their date from the first transaction's time, so
        their range is applied to clean rows. Periods cut by the range hold its dates only.
        """
        if name == "monthly_transaction_stats":
            return stats.month_page(self.days(first, last), self.get("pr_info"))
        if name == "rt_pr_hh24_clean":
            return self.hourly(first, last)
        if name in ("rt_tmspt_clean", "rt_node_hh24_clean"):
            sheet = name.removesuffix("_clean")
            if name in self.by_month:
                return self._months(name, first, last)
            return getattr(clean, name)(self.get(sheet), first, last) if name not in self.frames else clean.within(self.get(name), first, last)
        kept = "rt_cnt_clean" in self.by_month
        counts = self._months("rt_cnt_clean", first, last) if kept else clean.within(self.get("rt_cnt_clean"), first, last)
        if name == "rt_cnt_clean":
            return counts
        if name == "rt_cnt_daily_with_tmspt":
            return rollups.rt_cnt_daily_with_tmspt(counts, self.between("rt_tmspt_clean", first, last))
        if name == "rt_cnt_monthly_without":
            return rollups.rt_cnt_monthly_without(counts, self.excluded_codes)
        if name in ("rt_cnt_daily", "rt_cnt_weekly", "rt_cnt_monthly"):
            return getattr(rollups, name)(counts)
        raise KeyError(f"{name} has no transaction dates")

    def write(self, name: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a dataset once; later users read the written table.

        The rebalance hint gathers each partition value into few files and lets
        AQE split the ones that hold far more rows than others.
        """
        frame = self.get(name)
        if partition_by:
            frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
        frame.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{name}")
        self.frames[name] = self.spark.read.schema(frame.schema).parquet(f"{path}/{name}")
        return self.frames[name]

    def hourly(self, from_date=None, to_date=None) -> DataFrame:
        """Clean hourly rows in a date range; prunes the landed days when built from them."""
        if "rt_pr_hh24_clean" in self.frames:
            return self._months("rt_pr_hh24_clean", from_date, to_date)
        return clean.rt_pr_hh24_clean(self.frames["rt_pr_hh24"], from_date, to_date)

    def days(self, from_date, to_date) -> DataFrame:
        """The day frame of the hourly rows in a date range, written or built."""
        if "day_frame" in self.frames:
            return self._months("day_frame", from_date, to_date)
        return stats.day_frame(self.hourly(from_date, to_date))

    def _months(self, name: str, from_date=None, to_date=None) -> DataFrame:
        frame = self.frames[name]
        if name in self.by_month and from_date and to_date:
            frame = self.by_month[name].filter(F.col("_month").between(str(from_date)[:7], str(to_date)[:7])).drop("_month")
        elif from_date and to_date:
            # written tables are partitioned by month text
            frame = frame.filter(F.col("tx_yyyymm").between(str(from_date)[:7], str(to_date)[:7]))
        return clean.within(frame, from_date, to_date)

    def log_index(self) -> list[Row]:
        """Date ranges of the landed log days: one row per landed day and kind.

        They are recorded with each landing; only days that lack the record (and sheets that are not read from a lake) are looked through.
        """
        log = self.get("mon_log")
        if self.lake is None:
            return clean.log_days(log).collect()
        recorded = log_spans(self.spark, self.lake).collect()  # one row per landed day
        found = [Row(_dt=day["_dt"], monitor_kind=s["kind"], first=s["first"], last=s["last"]) for day in recorded for s in day["spans"]]
        known = {day["_dt"] for day in recorded}
        others = [day for (day,) in folders(self.spark, f"{self.lake}/_sheet=MON_LOG", "_dt") if day not in known]
        return found + (clean.log_days(log.filter(F.col("_dt").isin(others))).collect() if others else [])

    def log_of(self, kind: str, index: Sequence[Row], first: dt.date, last: dt.date | None = None) -> DataFrame:
        """The parsed log of one kind in a date range, read from the landed days that hold it."""
        sheet = monitor.sheet_between(self.get("mon_log"), index, kind, first, last)
        return clean.within(clean.monitor_log(sheet, self.prefixes).withColumn(
            "_day", F.col("log_createtime").cast("date")), first, last, "_day").drop("_day")

    def register_views(self, query: str | None = None, dates: tuple[dt.date, dt.date] | None = None) -> list[str]:
        """Temporary views of the datasets that can be built, or of those a query names; with
        ``dates``, transaction datasets hold that range."""
        names = []
        for name in DATASETS:
            if query is not None and not re.search(rf"\b{name}\b", query):
                continue
            try:
                frame = self.between(name, *dates) if dates and name in DATED else self.get(name)
            except KeyError:
                continue
            frame.createOrReplaceTempView(name)
            names.append(name)
        return names

    def sql(self, query: str, dates: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """Ad-hoc SQL over the datasets, or over a date range of the transaction datasets.

        Queries may call the table functions of ``ranges``, such as ``rt_cnt_between(first, last)``."""
        from tallyworks.plans import ranges  # builds on this module

        self.register_views(query, dates)
        ranges.register(self, query)
        return self.spark.sql(query)

    def _rt_cnt_clean(self):
        return clean.rt_cnt_clean(self.get("rt_cnt"))

    def _rt_tmspt_clean(self):
        return clean.rt_tmspt_clean(self.get("rt_tmspt"))

    def _rt_pr_hh24_clean(self):
        return clean.rt_pr_hh24_clean(self.get("rt_pr_hh24"))

    def _rt_node_hh24_clean(self):
        return clean.rt_node_hh24_clean(self.get("rt_node_hh24"))

    def _rt_cnt_daily(self):
        return rollups.rt_cnt_daily(self.get("rt_cnt_clean"))

    def _rt_cnt_daily_with_tmspt(self):
        return rollups.rt_cnt_daily_with_tmspt(self.get("rt_cnt_clean"), self.get("rt_tmspt_clean"))

    def _rt_cnt_weekly(self):
        return rollups.rt_cnt_weekly(self.get("rt_cnt_clean"))

    def _rt_cnt_monthly(self):
        return rollups.rt_cnt_monthly(self.get("rt_cnt_clean"))

    def _rt_cnt_monthly_without(self):
        return rollups.rt_cnt_monthly_without(self.get("rt_cnt_clean"), self.excluded_codes)

    def _monthly_transaction_stats(self):
        return stats.monthly_transaction_stats(self.get("rt_pr_hh24_clean"), self.get("pr_info"))

    def _monitor_log(self):
        return clean.monitor_log(self.get("mon_log"), self.prefixes)

    def _monitor_daily(self):
        return monitor.monitor_daily(self.get("monitor_log"), self.get("registry_info"))

    def _monitor_hourly(self):
        return monitor.monitor_hourly(self.get("monitor_log"), self.get("registry_info"))

    def _monitor_daily_jvm(self):
        return monitor.monitor_daily_jvm(self.get("monitor_log"), self.get("registry_info"))

    def _monitor_hourly_jvm(self):
        return monitor.monitor_hourly_jvm(self.get("monitor_log"), self.get("registry_info"))

    def _pr_info(self):
        return clean.pr_info(self.get("codes"))

    def _cfg_pr_info(self):
        return self.get("cfg_codes")

    def _registry_info(self):
        return clean.registry(self.get("registry"))
