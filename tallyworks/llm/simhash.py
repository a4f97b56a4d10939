"""Near duplicates by SimHash fingerprints, found through tables of distances to pivots.

Distances to reference fingerprints (pivots) bound the distance of a pair from below: it is at least the
largest difference of their coordinates. A table over all 64 bits can only be searched pair by pair, so the
distances are taken on each of eight byte segments: a pair within two bits has equal coordinates on at least six of
them. The coordinates of six segments (28 choices) are the key of an equi-join, and a key holds at most 2^16
different fingerprints, whatever the data. Inside a key, pairs whose coordinates over all bits differ by more than the
limit are discarded, survivors are verified by their Hamming distance, and only the links of a spanning forest go on.
Copies are folded before: a fingerprint is one row however many documents have it.

Edge cases: null, empty and wordless texts have fingerprint zero and are linked like any other; fewer words than a
shingle give one shingle; repeated rows share a fingerprint; a null document id is linked but names no
component unless it is alone (then the component is null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import quoted, table, written
from tallyworks.llm.components import components

SEED = 42
SEGMENTS = 8
#: Reference fingerprints. The first eight are the unit vectors of every segment and with the ninth (zero) tell
#: any two segments apart; the others are random and serve to discard pairs.
UNITS = [sum(1 << (8 * s + k) for s in range(8)) for k in range(8)]
PIVOTS = np.array([0, *UNITS, *np.random.default_rng(SEED).integers(0, 2**64, 24, dtype=np.uint64).tolist()], np.uint64)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLOCK = 1 << 15


def fingerprint(data: bytes, shingle: int) -> int:
    """Bits set in over half of the shingles' XXH64 values."""
    from xxhash import xxh64_intdigest

    found = data.translate(LOWER).split()
    if not found:
        return 0
    run = b" ".join(found)
    if len(found) <= shingle:
        return xxh64_intdigest(run, SEED)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = sizes.cumsum() + np.arange(len(found))
    starts = (ends - sizes)[: len(found) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    ones, n = np.zeros(64, np.int64), len(starts)
    for k in range(0, n, BLOCK):
        values = [xxh64_intdigest(run[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], ends[k : k + BLOCK])]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint32)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and the fingerprint as a signed long."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("fp", LongType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], schema=out)

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    """``_row`` (whole documents) with ``_fp``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([rows.schema["_row"], StructField("_fp", LongType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), pa.array(values.view(np.int64))], schema=out)

    return rows.select("_row", F.col("_row.text").cast("binary").alias("_text")).mapInArrow(run, schema)


def segment_codes(values: np.ndarray) -> np.ndarray:
    """For each fingerprint and segment, its distances to all pivots on that segment, folded to one number."""
    bits = values.view(np.uint8).reshape(-1, SEGMENTS)
    pivots = PIVOTS.view(np.uint8).reshape(-1, SEGMENTS)
    codes = np.zeros((len(values), SEGMENTS), np.uint64)
    for pivot in pivots[:9]:
        distance = np.bitwise_count(bits ^ pivot).astype(np.uint64)
        codes = codes * np.uint64(9) + distance
    return codes


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def join_keys(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint a key for every choice of segments of which ``max_bits`` are left out."""
    codes, keys = segment_codes(values), []
    for choice, left_out in enumerate(combinations(range(SEGMENTS), max_bits)):
        key = np.full(len(values), choice, np.uint64)
        for s in range(SEGMENTS):
            if s not in left_out:
                key = mixed(key + codes[:, s] + np.uint64(0x9E3779B97F4A7C15))
        keys.append(key)
    return np.stack(keys, 1)


def near_pairs(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``max_bits``: pivot coordinates discard, the bit count verifies."""
    coords = np.bitwise_count(values[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    order = np.argsort(coords[:, 0], kind="stable")
    first = coords[order, 0]
    ends = np.searchsorted(first, first + max_bits, "right")
    for i in range(len(order)):
        others = order[i + 1 : ends[i]]
        for p in range(9, coords.shape[1]):
            if not len(others):
                break
            others = others[np.abs(coords[others, p] - coords[order[i], p]) <= max_bits]
        others = others[np.bitwise_count(values[others] ^ values[order[i]]) <= max_bits]
        if len(others):
            yield order[i], others


def forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that hold together what is linked inside one key: at most one less than the values."""
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for i, others in near_pairs(values, max_bits):
        for j in others.tolist():
            a, b = find(int(i)), find(j)
            if a != b:
                root[b] = a
                links.append((int(i), j))
    return links


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links between different fingerprints that join all those within ``max_bits``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = join_keys(values, max_bits)
            rows = np.repeat(values.view(np.int64), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(rows)], names=["key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for group in batch.column(0):
                values = np.array(group.as_py(), np.int64)
                for i, j in forest(values.view(np.uint64), max_bits):
                    a.append(int(values[i]))
                    b.append(int(values[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keyed = distinct.select("fp").mapInArrow(deal, "key long, fp long")
    # at most 2^16 values a key (see above), so the lists are bounded
    groups = keyed.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps")).filter("size(fps) > 1")
    return groups.select("fps").distinct().mapInArrow(link, "a long, b long").distinct()


def rooted_duplicates(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """doc_id, fp, root (one fingerprint for each component) and component_id of every row of ``docs``."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = written(distinct, "distinct-fingerprints")
    linked = components(fingerprint_links(distinct, max_bits))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = rooted.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fp and component_id (smallest document id reachable) of every row of ``docs``."""
    return rooted_duplicates(docs, shingle, max_bits).drop("root")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Rows of ``docs`` that represent their component: one row of the smallest document id of each.

    Components that share their smallest document id keep a row each. Rows whose id is null never stand for others; they stay.
    """
    found = written(rooted_duplicates(docs.filter("doc_id IS NOT NULL"), shingle, max_bits), "rooted")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("_first")).select("_first.doc_id", "_first.fp")
    many = found.groupBy("doc_id").agg((F.min("fp") != F.max("fp")).alias("_many"))
    kept = first.join(many, "doc_id").select(F.col("doc_id").alias("_kept"), F.col("fp").alias("_kept_fp"), "_many")
    kept = written(kept, "kept")

    def once(rows: DataFrame, *more: str) -> DataFrame:
        least = rows.groupBy("_row.doc_id", *more).agg(F.min(F.struct(*[F.col("_row")[c].alias(c) for c in docs.columns])).alias("_row"))
        return least.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

    whole = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"))
    stay = whole.join(kept.filter("NOT _many"), F.col("_row.doc_id") == F.col("_kept"), "left_semi")
    # rows of an id that stands for different texts are told apart by their fingerprints, no others are read again
    unsure = with_fingerprint(whole.join(kept.filter("_many"), F.col("_row.doc_id") == F.col("_kept"), "left_semi"), shingle)
    sure = unsure.join(kept.filter("_many"), (F.col("_row.doc_id") == F.col("_kept")) & (F.col("_fp") == F.col("_kept_fp")), "left_semi")
    return once(stay).unionByName(once(sure, "_fp")).unionByName(docs.filter("doc_id IS NULL"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints link at two or fewer bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
