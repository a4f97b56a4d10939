"""Document fingerprints by one-permutation MinHash.

A text's shingles of five words are hashed once each; the hash's high bits choose a bin, the bin keeps the least of the
rest. An empty bin takes the value of the first occupied bin in a fixed random order of its own (optimal
densification), so that two texts agree in a bin with the probability of their sets' Jaccard similarity. The low bits of each
bin's value, mixed with the bin's number, are packed; bins that agree by chance alone are taken out of the likeness of two fingerprints.

Edge cases: null text counts as empty; a text of fewer words than a shingle is one shingle, a text without a word has the
empty fingerprint, which is wholly like itself and not at all like any other; repeated rows have equal fingerprints. In
``edited``, documents follow each other by descending id, null ids last, rows of one id by a hash of their texts; a single
document is its own next one; an empty table gives no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.common import table, written

SEED = 42
BINS = 256
BITS = 4  # low bits kept of each bin
SHINGLE = 5
#: Texts that are hashed at a time: at most this many, and about as many characters.
CHUNK_ROWS, CHUNK_CHARS = 512, 4_000_000
#: Different words whose hashes a worker keeps; the table is emptied beyond it.
KEPT_WORDS = 500_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Shape:
    bins: int = BINS
    bits: int = BITS
    shingle: int = SHINGLE

    def __post_init__(self):
        if self.bins < 2 or self.bins & (self.bins - 1) or self.bins > 65536 or not 1 <= self.bits <= 8:
            raise ValueError("bins must be a power of two from 2 to 65536, bits from 1 to 8")


class WordHashes(dict):
    """Hashes of words (as bytes), computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def factors(shingle: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, shingle, np.uint64) | np.uint64(1)


@lru_cache(4)
def probes(bins: int) -> np.ndarray:
    """For each bin, the order in which it looks at all bins for a value when it is empty."""
    return np.random.default_rng(SEED + 1).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of several texts, given the texts' word hashes one after another, and the text of each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = ends[owner] - np.arange(len(words))  # words from here to the end of the text
    out = np.zeros(len(words), np.uint64)
    for j, factor in enumerate(factors(shingle).tolist()):
        reach = left > j
        out[reach] += words[np.flatnonzero(reach) + j] * np.uint64(factor)
    first = np.zeros(len(words), bool)
    first[(ends - counts)[counts > 0]] = True
    whole = (left >= shingle) | (first & (left < shingle))
    return mixed(out[whole]), owner[whole]


def bin_values(texts: Sequence[bytes], shape: Shape, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The low bits of each bin of each text, and which texts have any word."""
    if len(known) > KEPT_WORDS:
        known.clear()
    parts, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.split()  # on bytes: at space and the five ASCII controls from tab to carriage return
        counts[i] = len(found)
        parts.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    hashes, owner = shingle_hashes(words, counts, shape.shingle)
    width = shape.bins.bit_length() - 1
    least = np.full((len(texts), shape.bins), EMPTY)
    place = owner * shape.bins + (hashes >> np.uint64(64 - width)).astype(np.int64)
    np.minimum.at(least.ravel(), place, hashes & np.uint64((1 << (64 - width)) - 1))
    used = least != EMPTY
    some = used.any(1)
    rows, bins = np.nonzero(~used & some[:, None])
    order = probes(shape.bins)
    for step in range(shape.bins):
        if not len(rows):
            break
        source = order[bins, step]
        hit = used[rows, source]
        least[rows[hit], bins[hit]] = least[rows[hit], source[hit]]
        rows, bins = rows[~hit], bins[~hit]
    # mixed with the bin's number first: one value that fills several bins must not agree by chance in all of them at once
    salted = mixed(least + np.arange(1, shape.bins + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (salted & np.uint64((1 << shape.bits) - 1)).astype(np.uint8), some


def packed(values: np.ndarray, some: np.ndarray, bits: int) -> list[bytes]:
    """The bins' bits one after another; empty for a text without a word."""
    single = (values[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    rows = np.packbits(single.reshape(len(values), -1), axis=1)
    return [row.tobytes() if any_word else b"" for row, any_word in zip(rows, some.tolist())]


def unpacked(fingerprint: bytes, shape: Shape) -> np.ndarray:
    single = np.unpackbits(np.frombuffer(fingerprint, np.uint8), count=shape.bins * shape.bits)
    return single.reshape(shape.bins, shape.bits) @ (1 << np.arange(shape.bits - 1, -1, -1))


def corrected(agreeing: np.ndarray, bits: int) -> np.ndarray:
    """Similarity from the share of agreeing bins: different values agree in ``bits`` bits with chance 2^-bits."""
    chance = 2.0**-bits
    return np.clip((agreeing - chance) / (1 - chance), 0.0, 1.0)


def likeness(a: bytes, b: bytes, shape: Shape = Shape()) -> float:
    """Estimated Jaccard similarity of two texts' shingles from their fingerprints."""
    if not a or not b:
        return float(a == b)
    return float(corrected((unpacked(a, shape) == unpacked(b, shape)).mean(), shape.bits))


def likenesses(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray, bits: int) -> np.ndarray:
    near = corrected((a == b).mean(1), bits)
    return np.where(some_a & some_b, near, (some_a == some_b).astype(float))


def with_fingerprints(docs: DataFrame, shape: Shape = Shape(), name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` in hex; a column of that name gives way."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    schema = T.StructType([*kept, T.StructField(name, T.StringType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                values, some = bin_values([t or b"" for t in part.column(part.num_columns - 1).to_pylist()], shape, known)
                own = [c.cast(f.type) for c, f in zip(part.columns, out)][:-1]
                yield pa.RecordBatch.from_arrays([*own, pa.array([p.hex() for p in packed(values, some, shape.bits)], pa.string())], schema=out)

    source = docs.select(*[docs[f"`{f.name}`"] for f in kept], F.col("text").cast("binary").alias(name))
    return source.mapInArrow(run, schema)


def edit(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by as much of the beginning of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


RESULT = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
          T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
          T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]


def compared(ids: Sequence, texts: Sequence[str], following: Sequence[str], shape: Shape, known: WordHashes) -> list[tuple]:
    """The result rows of some documents and the texts that follow them."""
    edits = [edit(t, n).encode() for t, n in zip(texts, following)]
    # what follows a document is mostly the next one of the list, and then hashed once
    chain = all(a is b for a, b in zip(texts[1:], following))
    own, some = bin_values([t.encode() for t in (*texts, *(following[-1:] if chain else following))], shape, known)
    n = len(texts)
    at = np.arange(1, n + 1) if chain else np.arange(n, 2 * n)
    new, some_new = bin_values(edits, shape, known)
    near_edited = likenesses(own[:n], some[:n], new, some_new, shape.bits).tolist()
    near_next = likenesses(own[:n], some[:n], own[at], some[at], shape.bits).tolist()
    prints = [p.hex() for p in packed(own[:n], some[:n], shape.bits)]
    changed = [p.hex() for p in packed(new, some_new, shape.bits)]
    return [(i, len(t), hashlib.sha256(e).hexdigest(), p, q, x, y)
            for i, t, e, p, q, x, y in zip(ids, texts, edits, prints, changed, near_edited, near_next)]


def edited(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Fingerprints of every document and of its edited text (see ``edit``), and how like the document's fingerprint is to the edited
    text's and to the next document's.

    Texts are moved once, sorted into ranges of ids. A task compares each document with the next one of its range; the last of
    a range meets the first of the following range in a second step, which moves two texts a range.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema["doc_id"].dataType
    whole = T.StructType([T.StructField("doc_id", kind), *RESULT])
    # an edge row holds the first or last text of a range
    schema = T.StructType([*whole.fields, T.StructField("edge", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("text", T.BinaryType())])
    out = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(out)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known = TaskContext.get().partitionId(), WordHashes()
        ids: list = []
        texts: list[str] = []
        chars, started = 0, False
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = text.as_py()
                ids.append(i)
                texts.append((value or b"").decode("utf-8", "replace"))
                chars += len(texts[-1])
                if not started:
                    started = True
                    yield batch_of([(i, *[None] * 6, "first", part, value or b"")])
                if len(ids) > CHUNK_ROWS or (chars > CHUNK_CHARS and len(ids) > 1):
                    rows = compared(ids[:-1], texts[:-1], texts[1:], shape, known)
                    yield batch_of([(*row, None, None, None) for row in rows])
                    ids, texts = ids[-1:], texts[-1:]
                    chars = len(texts[0])
        if len(ids) > 1:
            rows = compared(ids[:-1], texts[:-1], texts[1:], shape, known)
            yield batch_of([(*row, None, None, None) for row in rows])
        if ids:
            yield batch_of([(ids[-1], *[None] * 6, "last", part, texts[-1].encode())])

    text = F.col("text").cast("binary")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("h")
    found = written(ranges.mapInArrow(run, schema), "minhash")
    edges = found.filter("edge IS NOT NULL")
    # the ranges that hold documents: one number a range
    parts = [r["part"] for r in edges.filter("edge = 'last'").select("part").orderBy("part").collect()]
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    lasts = edges.filter("edge = 'last'").select("doc_id", "part", "text").join(follows, "part")
    firsts = edges.filter("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    short = to_arrow_schema(whole)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ends, starts = ([v.decode("utf-8", "replace") for v in batch.column(c).to_pylist()] for c in (1, 2))
            done = compared(batch.column(0).to_pylist(), ends, starts, shape, known) if ends else []
            columns = list(zip(*done)) if done else [()] * len(short)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, short)], schema=short)

    rest = lasts.join(firsts, "next").select("doc_id", "text", "following").mapInArrow(finish, whole)
    return found.filter("edge IS NULL").select(*whole.names).unionAll(rest)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with their likeness."""
    return edited(table(spark, sf_dir, "documents"))
