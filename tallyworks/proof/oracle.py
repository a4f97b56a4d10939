"""The datasets and reports once more as plain SQL, to check the DataFrame versions against.

Each entry is a common table expression; :func:`statement` puts the ones a query
mentions in front of it.
"""

from __future__ import annotations

import re

from tallyworks.proof import proxies

VIEWS: dict[str, str] = dict(proxies.SQL)

PREFIX_REMOVAL = "mon_content"
for _prefix in proxies.PREFIXES:
    PREFIX_REMOVAL = f"replace({PREFIX_REMOVAL}, '{_prefix}', '')"


def dated(sheet: str, key: str) -> str:
    """The sheet with the file's date and the date behind its year-less key."""
    return f"""(SELECT *, CASE WHEN g > file_dt THEN CAST(g - INTERVAL 1 YEAR AS DATE) ELSE g END AS key_dt
      FROM (SELECT *, TRY_CAST(year(file_dt) || '-' || left({key}, 2) || '-' || {key}[3:4] AS DATE) AS g
            FROM (SELECT *, CAST(strptime(_dt, '%Y%m%d') AS DATE) AS file_dt FROM {sheet})))"""


DAY_COLUMNS = """CAST(year(tx_dt) AS INT) AS tx_year, CAST(month(tx_dt) AS INT) AS tx_month,
       CAST(day(tx_dt) AS INT) AS tx_day, strftime(tx_dt, '%Y-%m') AS tx_yyyymm,
       strftime(file_dt, '%Y-%m-%d') AS file_dt_str, strftime(tx_dt, '%Y-%m-%d') AS tx_dt_str"""
META = "_file, _sheet, _dt, _ingest_ts"

VIEWS["v1"] = f"""
SELECT caldy, pr_id, total_cnt, ok_cnt, fail_cnt, rev_ok_cnt, timeout_cnt, other_err_cnt, file_dt, tx_ts_first,
       tx_ts_last, first_tx_raw, last_tx_raw, tx_dt, {DAY_COLUMNS},
       caldy = strftime(tx_dt, '%m%d') AS caldy_match_txdt, {META}
FROM (SELECT DISTINCT ON (tx_dt, pr_id) *
      FROM (SELECT *, coalesce(CAST(tx_ts_first AS DATE), key_dt) AS tx_dt
            FROM (SELECT *, CASE WHEN first_tx_raw LIKE '%T%.%' THEN TRY_CAST(first_tx_raw AS TIMESTAMP) END AS tx_ts_first,
                         CASE WHEN last_tx_raw LIKE '%T%.%' THEN TRY_CAST(last_tx_raw AS TIMESTAMP) END AS tx_ts_last
                  FROM {dated('rt_cnt', 'caldy')}))
      ORDER BY tx_dt, pr_id, _dt DESC, _file DESC)"""

VIEWS["v2"] = f"""
SELECT pr_id, pr_id AS pr_id_norm, caldy, avg_tm AS avg_tm_sec, avg_tm * 1000 AS avg_tm_ms, tx_dt, file_dt,
       {DAY_COLUMNS}, {META}
FROM (SELECT DISTINCT ON (tx_dt, pr_id) * FROM (SELECT *, key_dt AS tx_dt FROM {dated('rt_tmspt', 'caldy')})
      WHERE tx_dt IS NOT NULL ORDER BY tx_dt, pr_id, _dt DESC, _file DESC)"""

HOUR_COLUMNS = f"""caltm, avg_tm AS avg_tm_sec, avg_tm * 1000 AS avg_tm_ms, cnt AS tx_cnt, file_dt, tx_dt,
       {DAY_COLUMNS}, tx_hour, tx_dt + to_hours(tx_hour) AS tx_hour_ts,
       strftime(tx_dt + to_hours(tx_hour), '%Y-%m-%d %H:00:00') AS tx_hour_ts_str"""

VIEWS["v3"] = f"""
SELECT pr_id, {HOUR_COLUMNS}, {META}
FROM (SELECT DISTINCT ON (tx_dt, tx_hour, pr_id) *
      FROM (SELECT * REPLACE (trim(pr_id) AS pr_id), key_dt AS tx_dt, TRY_CAST(caltm[6:7] AS INT) AS tx_hour
            FROM {dated('rt_pr_hh24', 'caltm')})
      ORDER BY tx_dt, tx_hour, pr_id, _dt DESC, _file DESC)"""

VIEWS["v4"] = f"""
SELECT pr_id, node_id, {HOUR_COLUMNS}, left(caltm, 4) = strftime(tx_dt, '%m%d') AS caltm_match_txdt, {META}
FROM (SELECT * REPLACE (trim(pr_id) AS pr_id, trim(node_id) AS node_id), key_dt AS tx_dt,
             TRY_CAST(caltm[6:7] AS INT) AS tx_hour FROM {dated('rt_node_hh24', 'caltm')})"""

COUNTS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("total_cnt", "ok_cnt", "fail_cnt", "timeout_cnt"))
OK_RATE = "round(CAST(sum(ok_cnt) AS DOUBLE) * 100 / nullif(sum(total_cnt), 0), 2) AS ok_rate"

VIEWS["days"] = f"SELECT tx_dt, pr_id, {COUNTS} FROM v1 GROUP BY tx_dt, pr_id"

VIEWS["v5"] = f"""
SELECT strftime(tx_dt, '%Y') AS year, strftime(tx_dt, '%Y-%m') AS ym, strftime(tx_dt, '%G-%V') AS iso_yw,
       strftime(tx_dt, '%Y-%m-%d') AS tx_date, '日一二三四五六'[dayofweek(tx_dt) + 1] AS weekday, pr_id, {COUNTS}, {OK_RATE}
FROM days GROUP BY tx_dt, pr_id"""

VIEWS["v6"] = """
SELECT v5.*, avg_tm_sec, avg_tm_ms
FROM v5 LEFT JOIN (SELECT tx_dt_str, pr_id AS code, avg(avg_tm_sec) AS avg_tm_sec, avg(avg_tm_ms) AS avg_tm_ms
                   FROM v2 GROUP BY ALL) t ON v5.tx_date = t.tx_dt_str AND v5.pr_id = t.code"""


def rollup(keys: str, group: str, mean: str, mean_days: str, source: str = "days") -> str:
    return f"""
SELECT {keys}, min(tx_dt) AS data_start, max(tx_dt) AS data_end, count(DISTINCT tx_dt) AS data_days, {COUNTS},
       CAST(round(CAST(sum(total_cnt) AS DOUBLE) / nullif(count(DISTINCT tx_dt), 0)) AS BIGINT) AS avg_per_data_day,
       CAST(round(CAST(sum(total_cnt) AS DOUBLE) / {mean_days}) AS BIGINT) AS {mean},
       max(total_cnt) AS peak_day_cnt, first(tx_dt ORDER BY total_cnt DESC, tx_dt) AS peak_day, {OK_RATE}
FROM {source} GROUP BY {group}"""


VIEWS["v7"] = rollup(
    """strftime(tx_dt, '%Y') AS year, strftime(min(tx_dt), '%G-%V') AS iso_yw,
       CAST(date_trunc('week', min(tx_dt)) AS DATE) AS week_start,
       CAST(date_trunc('week', min(tx_dt)) AS DATE) + 6 AS week_end, pr_id""",
    "strftime(tx_dt, '%Y'), strftime(tx_dt, '%G-%V'), pr_id", "avg_per_7_days", "7")
MONTH_KEYS = """strftime(tx_dt, '%Y') AS year, strftime(tx_dt, '%Y-%m') AS ym,
       CAST(date_trunc('month', min(tx_dt)) AS DATE) AS month_start, last_day(min(tx_dt)) AS month_end"""
MONTH_GROUP = "strftime(tx_dt, '%Y'), strftime(tx_dt, '%Y-%m')"
VIEWS["v8"] = rollup(f"{MONTH_KEYS}, pr_id", f"{MONTH_GROUP}, pr_id", "avg_per_month_day",
                     "day(last_day(min(tx_dt)))")
VIEWS["v9"] = rollup(MONTH_KEYS, MONTH_GROUP, "avg_per_month_day", "day(last_day(min(tx_dt)))",
                     f"(FROM days WHERE pr_id <> '{proxies.EXCLUDED[0]}')")

VIEWS["v16"] = "SELECT seq_no, pr_id, pr_category AS category, pr_name AS name FROM codes"
VIEWS["v17"] = "SELECT COLUMNS(*)::VARCHAR FROM customer"
VIEWS["v18"] = "SELECT application, ipaddr, port FROM registry"


def republic(day: str) -> str:
    return f"(CAST(year({day}) - 1911 AS VARCHAR) || strftime({day}, '/%m/%d'))"


def page(source: str, key: str) -> str:
    """The statistics page over hourly rows that carry a period column."""
    return f"""
SELECT c.{key}, c.pr_id, i.category, coalesce(i.name, '未定義名稱') AS name, c.total_cnt,
       {republic('slow.d')} AS peak_day, slow.n AS peak_day_cnt,
       {republic('busy.d')} || ' ' || lpad(CAST(busy.h AS VARCHAR), 2, '0') || ':00~'
         || lpad(CAST(busy.h AS VARCHAR), 2, '0') || ':59' AS peak_hour_range,
       busy.n AS peak_hour_cnt, CAST(round(mean_ms) AS INT) AS avg_ms,
       {republic('slow.d')} || chr(10) || CAST(CAST(round(slow.ms) AS INT) AS VARCHAR) AS peak_ms_label,
       CAST(round(CAST(c.total_cnt AS DOUBLE) * 100 / a.all_cnt, 2) AS VARCHAR) || '%' AS share,
       {republic('first_day')} AS first_date, {republic('last_day')} AS last_date, active_days
FROM (SELECT {key}, pr_id, CAST(sum(n) AS BIGINT) AS total_cnt, sum(ms * n) / nullif(sum(n), 0) AS mean_ms,
             min(d) AS first_day, max(d) AS last_day, count(d) AS active_days,
             first({{'d': d, 'n': n, 'ms': ms}} ORDER BY ms DESC NULLS LAST, d) AS slow
      FROM (SELECT {key}, pr_id, tx_dt AS d, CAST(sum(tx_cnt) AS BIGINT) AS n,
                   sum(avg_tm_ms * tx_cnt) / nullif(sum(tx_cnt), 0) AS ms FROM {source} GROUP BY ALL) GROUP BY ALL) c
JOIN (SELECT {key}, pr_id, first({{'d': tx_dt, 'h': tx_hour, 'n': tx_cnt}} ORDER BY tx_cnt DESC, tx_dt, tx_hour) AS busy
      FROM {source} GROUP BY ALL) b ON c.{key} = b.{key} AND c.pr_id = b.pr_id
JOIN (SELECT {key}, CAST(sum(tx_cnt) AS BIGINT) AS all_cnt FROM {source} GROUP BY ALL) a ON c.{key} = a.{key}
JOIN v16 i ON c.pr_id = i.pr_id"""


VIEWS["month_hours"] = "SELECT strftime(tx_dt, '%Y-%m') AS ym, * FROM v3 WHERE tx_dt IS NOT NULL"
VIEWS["v10"] = page("month_hours", "ym")


def found(kind: str, key: str, scale: int = 10, strip: str = "") -> str:
    text = f"regexp_extract(body, '{key}:([^,]+)', 1)"
    if strip:
        text = f"replace({text}, '{strip}', '')"
    return f"CASE WHEN monitor_kind = '{kind}' THEN TRY_CAST({text} AS DECIMAL({scale}, 2)) END"


VIEWS["v11"] = f"""
SELECT monitor_kind, target_ip, target_port, log_createtime,
       {found('SERVER', 'usedCPURate', 5, '%')} AS used_cpu_rate, {found('SERVER', 'totalMem')} AS total_mem,
       {found('SERVER', 'freeMem')} AS free_mem, {found('SERVER', 'usedMemRate', 5, '%')} AS used_mem_rate,
       {found('SERVER', 'totalDisk')} AS total_disk, {found('SERVER', 'freeDisk')} AS free_disk,
       {found('SERVER', 'usedDiskRate', 5, '%')} AS used_disk_rate, {found('JVM', 'usedHeapMem')} AS used_heap_mem,
       {found('JVM', 'maxHeapMem')} AS max_heap_mem, {found('JVM', 'usedMemRate', 5, '%')} AS used_heap_mem_rate,
       CASE WHEN monitor_kind = 'DB_CONN' THEN regexp_extract(body, 'dbConnStatus:(.+)', 1) END AS db_conn_status,
       mon_content AS log_content, _file AS source_file, _sheet AS source_sheet, _dt AS report_dt,
       _ingest_ts AS ingest_timestamp
FROM (SELECT DISTINCT ON (monitor_kind, target_ip, target_port, log_createtime) *
      FROM (SELECT *, {PREFIX_REMOVAL} AS body, TRY_CAST(createtime AS TIMESTAMP) AS log_createtime FROM mon_log
            WHERE target_ip <> '' AND monitor_kind IS NOT NULL)
      ORDER BY monitor_kind, target_ip, target_port, log_createtime, _dt DESC, _file DESC)"""


def mean(column: str) -> str:
    """The mean of a two-digit decimal. ``avg`` would do, but its last bit depends on
    the plan the engine picks, which shows when the mean falls between two hundredths."""
    return f"round(CAST(sum({column}) * 100 AS DOUBLE) / (count({column}) * 100), 2)"


def measured(prefix: str, column: str, kinds: str = "max min avg") -> str:
    parts = []
    for kind in kinds.split():
        value = mean(column) if kind == "avg" else f"{kind}({column})"
        parts.append(f"{value} AS {kind}_{prefix}")
    return ", ".join(parts)


HOST = ", ".join([
    "count(*) AS record_count", measured("cpu_rate", "used_cpu_rate"), measured("mem_rate", "used_mem_rate"),
    measured("total_mem", "total_mem", "avg"), measured("used_mem", "total_mem - free_mem"),
    measured("disk_rate", "used_disk_rate"), measured("total_disk", "total_disk", "avg"),
    measured("used_disk", "total_disk - free_disk")])
HEAP = ", ".join([
    "count(*) AS record_count", measured("used_heap_mem", "used_heap_mem"),
    measured("max_heap_mem", "max_heap_mem", "avg max"), measured("used_heap_mem_rate", "used_heap_mem_rate", "max avg"),
    measured("used_heap_rate", "used_heap_mem_rate", "min")])
HOUR = "CAST(hour(log_createtime) AS INT) AS log_hour"
ON_HOST = "FROM v11 LEFT JOIN (SELECT DISTINCT application, ipaddr FROM v18) a ON target_ip = ipaddr WHERE monitor_kind = 'SERVER' GROUP BY ALL"


def on_port(condition: str) -> str:
    return f"""FROM v11 LEFT JOIN (SELECT DISTINCT application, ipaddr, port FROM v18) a ON target_ip = ipaddr AND {condition}
WHERE monitor_kind = 'JVM' AND used_heap_mem IS NOT NULL GROUP BY ALL"""


VIEWS["v12"] = f"SELECT application, target_ip, CAST(log_createtime AS DATE) AS log_date, {HOST} {ON_HOST}"
VIEWS["v13"] = f"SELECT application, target_ip, CAST(log_createtime AS DATE) AS log_date, {HOUR}, {HOST} {ON_HOST}"
VIEWS["v14"] = f"""SELECT application, target_ip, target_port, CAST(CAST(log_createtime AS DATE) AS TIMESTAMP) AS log_date, {HEAP}
{on_port('TRY_CAST(target_port AS BIGINT) = port')}"""
VIEWS["v15"] = f"""SELECT application, target_ip, target_port, CAST(log_createtime AS DATE) AS log_date, {HOUR}, {HEAP}
{on_port('target_port = CAST(port AS VARCHAR)')}"""

# reports

P = proxies.params()
M = proxies.monitor_params()
MONTHS = ("1998-01", "1998-02", "1998-03", "1998-04", "1998-05", "1998-06")
CODES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

VIEWS["target"] = f"SELECT * FROM month_hours WHERE ym = '{P.target_month}'"
VIEWS["history"] = f"SELECT * FROM month_hours WHERE ym BETWEEN '{P.history_start_month}' AND '{P.history_end_month}'"
VIEWS["r1"] = """SELECT pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt, count(DISTINCT tx_dt) AS active_days
FROM target GROUP BY pr_id"""
VIEWS["r2"] = "SELECT tx_dt_str AS tx_date, pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt FROM target GROUP BY ALL"


def pivoted(source: str, key: str, column: str, values, measures: dict[str, str]) -> str:
    parts = []
    for value in values:
        for suffix, measure in measures.items():
            parts.append(f"max(CASE WHEN {column} = '{value}' THEN {measure} END) AS \"{value}{suffix}\"")
    return f"SELECT {key}, {', '.join(parts)} FROM {source} GROUP BY {key}"


VIEWS["r3"] = pivoted("r2", "tx_date", "pr_id", CODES, {"": "total_cnt"})


def peaks(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, strftime(top.d, '%Y-%m-%d') AS peak_day, top.n AS peak_day_cnt, top.h AS peak_hour, top.hn AS peak_hour_cnt
FROM (SELECT {keys}, first({{'d': d, 'n': n, 'h': h, 'hn': hn}} ORDER BY n DESC, d) AS top
      FROM (SELECT {keys}, tx_dt AS d, CAST(sum(tx_cnt) AS BIGINT) AS n, max(tx_cnt) AS hn,
                   first(tx_hour ORDER BY tx_cnt DESC, tx_hour) AS h FROM {source} GROUP BY ALL) GROUP BY ALL)"""


VIEWS["r4"] = peaks("target", "pr_id")
VIEWS["r5"] = f"""
SELECT r4.pr_id, peak_day, peak_day_cnt, {', '.join(
    f"CAST(sum(CASE WHEN tx_hour = {h} THEN tx_cnt END) AS BIGINT) AS h{h:02d}" for h in range(24))}
FROM r4 JOIN target t ON r4.pr_id = t.pr_id AND r4.peak_day = t.tx_dt_str GROUP BY ALL"""
VIEWS["r6"] = """
SELECT ym, c.pr_id, category, name, total_cnt, CAST(round(ms) AS INT) AS avg_ms,
       round(CAST(total_cnt AS DOUBLE) * 100 / (SELECT sum(tx_cnt) FROM target), 2) AS share_pct
FROM (SELECT ym, pr_id, CAST(sum(n) AS BIGINT) AS total_cnt, sum(ms * n) / nullif(sum(n), 0) AS ms
      FROM (SELECT ym, pr_id, tx_dt, sum(tx_cnt) AS n, sum(avg_tm_ms * tx_cnt) / nullif(sum(tx_cnt), 0) AS ms
            FROM target GROUP BY ALL) GROUP BY ALL) c JOIN v16 ON c.pr_id = v16.pr_id"""
VIEWS["r7"] = "SELECT * FROM r6 WHERE category = 'update' ORDER BY total_cnt DESC, pr_id LIMIT 6"
VIEWS["r8"] = "SELECT * FROM r6 WHERE category = 'query' ORDER BY total_cnt DESC, pr_id LIMIT 6"
DIFF_PCT = "round(CAST(coalesce({0}, 0) - coalesce({1}, 0) AS DOUBLE) * 100 / nullif({1}, 0), 2)"
VIEWS["r9"] = f"""
SELECT pr_id, b.total_cnt AS prev_cnt, a.total_cnt AS cur_cnt,
       coalesce(a.total_cnt, 0) - coalesce(b.total_cnt, 0) AS diff_cnt,
       {DIFF_PCT.format('a.total_cnt', 'b.total_cnt')} AS diff_pct
FROM (FROM v10 WHERE ym = '{P.target_month}') a
FULL JOIN (FROM v10 WHERE ym = '{P.previous_target_month}') b USING (pr_id)"""
VIEWS["host_days"] = f"SELECT * FROM v12 WHERE log_date BETWEEN DATE '{M.range_start_date}' AND DATE '{M.range_end_date}'"
VIEWS["r10"] = f"""
SELECT application, target_ip, count(*) AS days, max(max_cpu_rate) AS max_cpu_rate,
       {mean('CAST(avg_cpu_rate AS DECIMAL(9, 2))')} AS avg_cpu_rate, max(max_mem_rate) AS max_mem_rate,
       {mean('CAST(avg_mem_rate AS DECIMAL(9, 2))')} AS avg_mem_rate
FROM host_days GROUP BY ALL"""
VIEWS["r11"] = """SELECT application, target_ip, log_date, max_cpu_rate, avg_cpu_rate, max_mem_rate, avg_mem_rate
FROM host_days"""
VIEWS["r12"] = "SELECT ym, pr_id, CAST(sum(tx_cnt) AS BIGINT) AS total_cnt FROM history GROUP BY ALL"
VIEWS["r13"] = pivoted("r12", "pr_id", "ym", MONTHS, {"": "total_cnt"})
VIEWS["r16"] = peaks("history", "ym, pr_id")
VIEWS["r14"] = "SELECT ym, pr_id, peak_day, peak_day_cnt FROM r16"
VIEWS["r15"] = pivoted("r14", "pr_id", "ym", MONTHS, {"_peak_day": "peak_day", "_peak_day_cnt": "peak_day_cnt"})
VIEWS["r17"] = pivoted("r16", "pr_id", "ym", MONTHS, {
    f"_{c}": c for c in ("peak_day", "peak_day_cnt", "peak_hour", "peak_hour_cnt")})
VIEWS["cur_hours"] = f"""SELECT 'cur' AS period, * FROM v3
WHERE tx_hour_ts BETWEEN TIMESTAMP '{P.range_start_time}:00' AND TIMESTAMP '{P.range_end_time}:00'"""
VIEWS["prev_hours"] = f"""SELECT 'prev' AS period, * FROM v3
WHERE tx_hour_ts BETWEEN TIMESTAMP '{P.previous_range_start_time}:00' AND TIMESTAMP '{P.previous_range_end_time}:00'"""
VIEWS["cur_page"] = page("cur_hours", "period")
VIEWS["prev_page"] = page("prev_hours", "period")
VIEWS["r18"] = "SELECT * EXCLUDE (period) FROM cur_page"


def beside(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{side}.{c} AS {name}_{c}" for side, name in (("a", "cur"), ("b", "prev")) for c in columns)


JOINED = "FROM cur_page a FULL JOIN prev_page b ON a.pr_id = b.pr_id AND a.category = b.category AND a.name = b.name"
NAMES = "coalesce(a.pr_id, b.pr_id) AS pr_id, coalesce(a.category, b.category) AS category, coalesce(a.name, b.name) AS name"
PAGE_COLUMNS = ("total_cnt", "peak_day", "peak_day_cnt", "peak_hour_range", "peak_hour_cnt", "avg_ms",
                "peak_ms_label", "share", "active_days")
VIEWS["r19"] = f"SELECT {NAMES}, {beside(PAGE_COLUMNS)} {JOINED}"
VIEWS["r20"] = f"""
SELECT {NAMES}, {beside(('total_cnt', 'avg_ms'))},
       coalesce(a.total_cnt, 0) - coalesce(b.total_cnt, 0) AS diff_cnt,
       {DIFF_PCT.format('a.total_cnt', 'b.total_cnt')} AS diff_pct,
       coalesce(a.avg_ms, 0) - coalesce(b.avg_ms, 0) AS diff_ms {JOINED}"""

# exports: ten or four days up to the last date, capped; the order is total
EXPORTS = {"e_daily": ("v12", 10, ""), "e_hourly": ("v13", 4, ", log_hour DESC NULLS LAST"),
           "e_daily_jvm": ("v14", 10, ", target_port NULLS LAST"),
           "e_hourly_jvm": ("v15", 4, ", log_hour DESC NULLS LAST, target_port NULLS LAST")}
for _name, (_view, _days, _more) in EXPORTS.items():
    VIEWS[f"{_name}_all"] = f"""SELECT * FROM {_view} WHERE log_date >= (SELECT max(log_date) FROM {_view}) - INTERVAL {_days} DAY"""
    VIEWS[_name] = f"""SELECT * FROM {_view} WHERE log_date >= (SELECT max(log_date) FROM {_view}) - INTERVAL {_days} DAY
ORDER BY application NULLS LAST, target_ip NULLS LAST, log_date DESC NULLS LAST{_more} LIMIT 10000"""


def statement(query: str) -> str:
    """The query with the table expressions it needs, in the order they are defined."""
    wanted: set[str] = set()
    pending = [query]
    while pending:
        words = set(re.findall(r"[a-z]\w*", pending.pop()))
        for name in VIEWS.keys() & words - wanted:
            wanted.add(name)
            pending.append(VIEWS[name])
    if not wanted:
        return query
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted) + "\n" + query
