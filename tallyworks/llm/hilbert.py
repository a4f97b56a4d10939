"""Sharding by Hilbert-curve order: rows that are near in several metadata columns share a file.

Each dimension is quantised to ``2**bits`` cells by quantiles (approximate ones of numbers, those of whole values of strings), the cells give an index on the
Hilbert curve, rows are range partitioned and sorted by (index, tie columns), and the order is cut into
runs. Files then cover small boxes, so a filter on any of the dimensions prunes.

Edge cases: null in a dimension falls into cell 0; strings are ordered by all their bytes; an empty
table gives no rows; rows equal in all ordering columns are interchangeable; input columns named like an
output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import quoted, table, with_new, written

OUTPUT = ("hilbert", "shard", "slot")


def ordinal(df: DataFrame, name: str) -> Column:
    """A column other than a string as an order-preserving double."""
    kind = dict(df.dtypes)[name]
    col = F.col(quoted(name))
    if kind in ("date", "timestamp"):
        return F.unix_timestamp(col.cast("timestamp")).cast("double")
    return col.cast("double")


def string_cuts(df: DataFrame, name: str, count: int) -> list[str]:
    """At most ``count - 1`` values that cut the rows of a string column into ``count`` runs, as its quantiles do.

    Different values are counted and range partitioned; running totals of the counts tell which values hold a cut.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(F.col(quoted(name)).alias("_value")).filter("_value IS NOT NULL").groupBy("_value").agg(F.count("*").alias("_n"))
    placed = values.repartitionByRange(parts, "_value").sortWithinPartitions("_value")
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_place", 33)), "values")
    # one row per range partition, as in hilbert_shards
    sizes = placed.groupBy("_part").agg(F.sum("_n").alias("_size"))
    starts = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"),
                          F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_total"))
    upto = F.col("_start") + F.sum("_n").over(Window.partitionBy("_part").orderBy("_place"))
    ranked = placed.join(F.broadcast(starts), "_part").withColumn("_upto", upto)
    holds = f"least((_upto * {count}) div _total, {count - 1}) > ((_upto - _n) * {count}) div _total"
    return [r._value for r in ranked.filter(holds).select("_value").collect()]


def cells(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """Each dimension's cell, 0 to ``2**bits - 1``, from one aggregate over the table and one for each string.

    The driver gets at most ``len(dims) * (2**bits - 1)`` values, whatever the size of the table.
    """
    kinds = dict(df.dtypes)
    shares = [i / 2**bits for i in range(1, 2**bits)]
    numbers = [d for d in dims if kinds[d] != "string"]
    found = df.agg(*[F.percentile_approx(ordinal(df, d), shares, 10_000).alias(f"c{i}") for i, d in enumerate(numbers)]).first() if numbers else ()
    cuts = dict(zip(numbers, found)) | {d: string_cuts(df, d, 2**bits) for d in dims if kinds[d] == "string"}

    def cell(d: str) -> Column:
        text = kinds[d] == "string"
        value, bounds = F.col(quoted(d)) if text else ordinal(df, d), sorted(set(cuts[d] or ()))
        # the lambda takes the bound alone: a second parameter would be its place in the array
        below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= value)) if bounds else F.lit(0)
        return F.when(value.isNull() if text else value.isNull() | F.isnan(value), 0).otherwise(below).cast("int")

    return [cell(d) for d in dims]


def curve_index(names: list[str], bits: int) -> Column:
    """Hilbert index of integer columns below ``2**bits`` (Skilling's transform as array expressions)."""
    d = len(names)
    axis = f"cast(k % {d} as int)"
    bit = f"shiftleft(1, cast({bits - 1} - k div {d} as int))"
    toggle = f"if((x[{axis}] & {bit}) != 0, {bit} - 1, (x[0] ^ x[{axis}]) & ({bit} - 1))"
    turned = (
        f"aggregate(sequence(0, {(bits - 1) * d - 1}), array({', '.join(names)}), (x, k) -> transform(x, (v, i) -> "
        f"case when i = 0 then v ^ {toggle} when i = {axis} and (x[{axis}] & {bit}) = 0 then v ^ {toggle} else v end))"
    ) if bits > 1 else f"array({', '.join(names)})"
    gray = f"transform(t, (v, i) -> aggregate(slice(t, 1, i + 1), 0, (a, b) -> a ^ b))"
    flip = (f"aggregate(sequence(1, {bits - 1}), 0, (a, m) -> if((g[{d - 1}] & shiftleft(1, m)) != 0, "
            "a ^ (shiftleft(1, m) - 1), a))") if bits > 1 else "0"
    woven = (f"aggregate(sequence(0, {bits * d - 1}), 0L, (a, k) -> a * 2 + "
             f"(shiftright(h[{axis}], cast({bits - 1} - k div {d} as int)) & 1))")
    return F.expr(
        f"transform(array({turned}), t -> transform(array({gray}), g -> transform(array({flip}), f -> "
        f"transform(array(transform(g, v -> v ^ f)), h -> {woven})[0])[0])[0])[0]"
    )


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, ties: list[str], bits: int = 5) -> DataFrame:
    """``df`` with ``hilbert``, ``shard`` (0 to ``shards - 1``, row counts at most one apart) and ``slot``.

    The order is a range partitioning: position = rows of earlier partitions + place in the own
    partition. Ties are cut by ``ties``, so a hot cell is split over partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_cell{i}" for i in range(len(dims))]
    celled = df.select("*", *[c.alias(n) for n, c in zip(names, cells(df, dims, bits))])
    indexed = with_new(celled, {"hilbert": curve_index(names, bits)}).drop(*names)
    order = ["hilbert", *map(quoted, ties)]
    placed = indexed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(with_new(placed, {"_place": F.monotonically_increasing_id()}), "hilbert")
    part = F.shiftright("_place", 33)
    # one row per range partition, so both windows and the broadcast are bounded by the partition count
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    ranked = placed.join(F.broadcast(starts), part == F.col("_part"))
    rank = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    shard = F.expr(f"({shards} * _rank) div _total")
    first = F.expr(f"(_shard * _total + {shards - 1}) div {shards}")
    out = ranked.withColumn("_rank", rank).withColumn("_shard", shard).withColumn("_slot", F.col("_rank") - first)
    out = with_new(out, {"shard": F.col("_shard").cast("int"), "slot": F.col("_slot")})
    return out.drop("_place", "_part", "_start", "_total", "_rank", "_shard", "_slot")


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order, one sorted run per file."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, near in language, source and length."""
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = hilbert_shards(narrow, ["lang", "source", "size"], 16, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )
