import itertools
import zlib

from pyspark.sql import functions as F

from tallyworks.llm import hilbert
from tests.llm.conftest import SF


def test_curve_visits_neighbours(spark):
    for d, bits in ((2, 3), (3, 2), (3, 1), (1, 3)):
        cells = list(itertools.product(range(2**bits), repeat=d))
        df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(d)))
        rows = df.select("*", hilbert.curve_index([f"c{i}" for i in range(d)], bits).alias("h")).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(2 ** (bits * d)))
        if d > 1:
            assert all(sum(abs(a[i] - b[i]) for i in range(d)) == 1 for a, b in zip(rows, rows[1:]))


def laws(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = hilbert.op9_sharding(spark, SF).collect()
    laws(rows, 16)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_boxes_are_small(spark):
    grid = spark.range(4096).select((F.col("id") % 64).alias("x"), F.expr("id div 64").alias("y"))
    rows = hilbert.hilbert_shards(grid, ["x", "y"], 16, ["x", "y"], bits=4)
    boxes = rows.groupBy("shard").agg(((F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1)).alias("area")).collect()
    assert sum(b.area for b in boxes) < 2 * 4096


def test_odd_rows(spark, docs_of, odd_texts, tmp_path):
    docs = docs_of([*odd_texts, *["hot"] * 200], shard="old", hilbert=1)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("lang")))
    out = hilbert.hilbert_shards(docs, ["lang", "n_chars"], 7, ["doc_id"])
    rows = out.collect()
    laws(rows, 7)
    assert len(rows) == len(odd_texts) + 200 and out.columns[-1] == "slot" and len(set(out.columns)) == len(out.columns)
    hilbert.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    assert hilbert.hilbert_shards(docs.filter("false"), ["lang", "n_chars"], 7, ["doc_id"]).collect() == []
    same = docs.filter("doc_id = 3").unionAll(docs.filter("doc_id = 3"))
    laws(hilbert.hilbert_shards(same, ["lang"], 3, ["doc_id"]).collect(), 3)


def test_strings_count_as_a_whole(spark):
    names = [f"https://host{i:02d}.example/ü" for i in range(32)]
    df = spark.range(3200).select((F.col("id") % 40).alias("x"), F.element_at(F.array(*map(F.lit, names)), (F.expr("id div 100") + 1).cast("int")).alias("s"))
    df = df.unionAll(spark.createDataFrame([(0, None)] * 5, "x long, s string"))
    rows = df.select("s", hilbert.cells(df, ["s"], 3)[0].alias("cell")).distinct().collect()
    assert {r.s: r.cell for r in rows} == {n: min(7, (i + 1) // 4) for i, n in enumerate(names)} | {None: 0}
    boxes = hilbert.hilbert_shards(df.filter("s IS NOT NULL"), ["s", "x"], 16, ["s", "x"], bits=3).groupBy("shard").agg(F.count_distinct("s").alias("n")).collect()
    assert sum(b.n for b in boxes) < 16 * 16
    hot = spark.createDataFrame([("b",)] * 90 + [("a",)] * 5 + [("c",)] * 5, "s string")
    rows = hot.select("s", hilbert.cells(hot, ["s"], 2)[0].alias("cell")).distinct().collect()
    assert {r.s: r.cell for r in rows} == {"a": 0, "b": 1, "c": 1}


def test_cells_of_numbers(spark):
    rows = spark.range(64).select("id", hilbert.cells(spark.range(64), ["id"], 3)[0].alias("cell")).collect()
    assert all(abs(r.cell - r.id / 8) <= 1 for r in rows) and {r.cell for r in rows} == set(range(8))
