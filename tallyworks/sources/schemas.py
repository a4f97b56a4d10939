"""Fixed schemas of the landed sheets and dimensions.

Reading with a declared schema costs no inference pass and does not drift from
day to day. Landed files keep the header text of the sheet; the readers rename
it to the English names used everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = [
    T.StructField("_file", T.StringType()),
    T.StructField("_sheet", T.StringType()),
    T.StructField("_dt", T.StringType()),
    T.StructField("_ingest_ts", T.LongType()),
]

# The sheets that are landed.
TARGET_SHEETS = ("RT_CNT", "RT_TMSPT", "RT_PR_HH24", "RT_NODE_HH24", "BT_CNT", "MON_LOG", "ERR_LOG")

# Header text of each sheet, its English name and its type.
SHEET_COLUMNS: dict[str, list[tuple[str, str, T.DataType]]] = {
    "RT_CNT": [
        ("CALDY", "caldy", T.StringType()),
        ("PR_ID", "pr_id", T.StringType()),
        ("總筆數", "total_cnt", T.LongType()),
        ("成功", "ok_cnt", T.LongType()),
        ("失敗", "fail_cnt", T.LongType()),
        ("失敗但沖正成功", "rev_ok_cnt", T.LongType()),
        ("TIMEOUT", "timeout_cnt", T.LongType()),
        ("其他錯誤", "other_err_cnt", T.LongType()),
        ("首筆交易", "first_tx_raw", T.StringType()),
        ("尾筆交易", "last_tx_raw", T.StringType()),
    ],
    "RT_TMSPT": [
        ("PR_ID", "pr_id", T.StringType()),
        ("CALDY", "caldy", T.StringType()),
        ("AVG_TM", "avg_tm", T.DoubleType()),
    ],
    "RT_PR_HH24": [
        ("PR_ID", "pr_id", T.StringType()),
        ("CALTM", "caltm", T.StringType()),
        ("AVG_TM", "avg_tm", T.DoubleType()),
        ("CNT", "cnt", T.LongType()),
    ],
    "RT_NODE_HH24": [
        ("PR_ID", "pr_id", T.StringType()),
        ("NODE_ID", "node_id", T.StringType()),
        ("CALTM", "caltm", T.StringType()),
        ("AVG_TM", "avg_tm", T.DoubleType()),
        ("CNT", "cnt", T.LongType()),
    ],
    "MON_LOG": [
        ("MONITOR_KIND", "monitor_kind", T.StringType()),
        ("TARGET_IP", "target_ip", T.StringType()),
        ("TARGET_PORT", "target_port", T.StringType()),
        ("MON_CONTENT", "mon_content", T.StringType()),
        ("CREATETIME", "createtime", T.StringType()),
    ],
}

# The code dimension's header text.
CODE_COLUMNS: list[tuple[str, str, T.DataType]] = [
    ("順序", "seq_no", T.IntegerType()),
    ("交易類型", "pr_id", T.StringType()),
    ("交易名稱", "pr_name", T.StringType()),
    ("電文分類", "pr_category", T.StringType()),
    ("交易名稱(調整)", "pr_name_adj", T.StringType()),
]

# The registry's field names.
REGISTRY_COLUMNS: list[tuple[str, str, T.DataType]] = [
    ("application", "application", T.StringType()),
    ("ipAddr", "ipaddr", T.StringType()),
    ("port", "port", T.LongType()),
]

# Literal openings of the monitor text, removed before parsing.
CONTENT_PREFIXES = (
    "JVM資源使用狀況-監控結果資訊：",
    "虛擬伺服器資源使用狀況-監控結果資訊：",
    "系統產生 資料庫連線-監控結果資訊：",
)

# Codes left out of the "all but" month rollup; name of an unnamed code.
EXCLUDED_CODES = ("FAC2FAS",)
UNNAMED = "未定義名稱"

# Column labels of the delivered tables, applied only by the CSV sink.
LABELS: dict[str, dict[str, str]] = {
    "rt_cnt_daily": {
        "year": "年", "ym": "年月", "iso_yw": "年週", "tx_date": "交易日期", "weekday": "星期",
        "pr_id": "交易類型", "total_cnt": "交易總筆數", "ok_cnt": "成功筆數", "fail_cnt": "失敗筆數",
        "timeout_cnt": "逾時筆數", "ok_rate": "成功率百分比",
        "avg_tm_sec": "平均交易時間(秒)", "avg_tm_ms": "平均交易時間(毫秒)",
    },
    "rt_cnt_weekly": {
        "year": "年", "iso_yw": "年週", "week_start": "週開始日", "week_end": "週結束日",
        "data_start": "資料開始日", "data_end": "資料結束日", "pr_id": "交易類型",
        "data_days": "有資料日數", "total_cnt": "週交易總筆數",
        "avg_per_data_day": "日均交易量_有資料日", "avg_per_7_days": "日均交易量_週平均",
        "peak_day_cnt": "單日峰值交易量", "peak_day": "單日峰值日期",
        "ok_cnt": "週成功筆數", "fail_cnt": "週失敗筆數", "timeout_cnt": "週逾時筆數",
        "ok_rate": "週成功率百分比",
    },
    "rt_cnt_monthly": {
        "year": "年", "ym": "年月", "month_start": "月開始日", "month_end": "月結束日",
        "data_start": "資料開始日", "data_end": "資料結束日", "pr_id": "交易類型",
        "data_days": "有資料日數", "total_cnt": "月交易總筆數",
        "avg_per_data_day": "日均交易量_有資料日", "avg_per_month_day": "日均交易量_月平均",
        "peak_day_cnt": "單日峰值交易量", "peak_day": "單日峰值日期",
        "ok_cnt": "月成功筆數", "fail_cnt": "月失敗筆數", "timeout_cnt": "月逾時筆數",
        "ok_rate": "月成功率百分比",
    },
    "monthly_transaction_stats": {
        "ym": "年月", "pr_id": "交易類型", "category": "類別", "name": "名稱", "total_cnt": "交易總量",
        "peak_day": "峰日", "peak_day_cnt": "峰日交易量", "peak_hour_range": "峰時區間",
        "peak_hour_cnt": "峰時交易量", "avg_ms": "平均處理時間", "peak_ms_label": "峰值處理時間",
        "share": "交易量佔比", "first_date": "交易開始日期", "last_date": "交易結束日期",
        "active_days": "實際交易天數",
    },
    "monitor": {"target_ip": "TARGET_IP", "target_port": "TARGET_PORT"},
}


def header_schema(columns: list[tuple[str, str, T.DataType]]) -> T.StructType:
    """The schema with header text as the field names (landed JSON, dimension CSV)."""
    return T.StructType([T.StructField(header, kind) for header, _, kind in columns])


def landed_schema(sheet: str) -> T.StructType:
    return T.StructType(header_schema(SHEET_COLUMNS[sheet]).fields + LINEAGE)
