"""Removal of long repeats across documents, found through recompression.

Recompression names runs and pairs of symbols round by round. A name is a hash of what it stands for, so it is the
same in every document and task and a round needs no table of names: rounds run inside one pass, and Spark
groups the names they end in. Rounds are bounded so that the inside of a window is provably named alike wherever it
occurs: runs of exactly two words are named (at most 2 words lost at each side of a window), then two
rounds of pairs (left-class symbol before right-class symbol; 2 and 4 more words lost). Thus the words 8 to 41 of a
50-word window fall into the same symbols of at most 8 words in every document. Of the symbols that start at word 8 to 34
the one with the least name is the window's anchor, and the 24 words around it, named once more, are its key.
Windows that occur in two documents have equal keys, so:

1. every document is folded to its keys and to a digest of all its words; copies of a whole
   document are folded to the one with the smallest id, whose windows cover theirs;
2. keys that occur in two documents are found by aggregation;
3. the consecutive windows of one anchor with such a key are a span; equal spans (128-bit hashes) need no closer look: all but
   those of the smallest id are covered;
4. where a key has different spans, each window of one span of a kind is hashed (128 bits) and matched. A word is
   removed if it is covered by a window that also starts in a document with a smaller id.

Edge cases: null text has no words; texts under 50 words lose nothing; a null document id loses nothing and
covers nothing; rows of one id do not cover each other; repeats inside one document stay; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

from tallyworks.llm.common import table, with_new, written

WINDOW = 50
LOST = 8  # words at each side of a window whose symbols may depend on what is outside
LONGEST = 8  # words of the longest symbol
REACH = WINDOW - 2 * LOST - LONGEST + 1  # places at which an anchor may start
AROUND = (LOST, WINDOW - LOST - REACH + 1)  # words of the key before the anchor's start and from it on
CHUNK = 400_000  # words handled at a time; a longer document is handled alone
KEPT_WORDS = 200_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class WordNames(dict):
    """64-bit names of words; a bounded table per worker."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= KEPT_WORDS:
            self.clear()
        found = xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


@lru_cache(1)
def word_names() -> WordNames:
    return WordNames()


@lru_cache(4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i up to n."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        steps = np.full(n + 1, b, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def span_hash(names: np.ndarray, base: int, starts: np.ndarray, before: int, after: int) -> np.ndarray:
    """Hash of the words from ``starts - before`` to ``starts + after``."""
    size = 1 << max(16, int(len(names)).bit_length())
    up, down = powers(base, size)
    total = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * up[: len(names)], out=total[1:])
    first = starts - before
    return (total[starts + after] - total[first]) * down[first]


def recompress(names: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and starts of the symbols after one round of runs and two of pairs; ``ends`` marks last words."""
    starts, last = np.arange(len(names)), ends

    def merge(here: np.ndarray, names, starts, last):
        """Joins the symbols at ``here`` with their successors."""
        names = names.copy()
        names[:-1][here] = mixed(names[:-1][here] * np.uint64(3) + mixed(names[1:][here]))
        last = last.copy()
        last[:-1][here] = last[1:][here]
        keep = np.ones(len(names), bool)
        keep[1:][here] = False
        return names[keep], starts[keep], last[keep]

    if len(names) > 1:
        same = (names[:-1] == names[1:]) & ~last[:-1]
        padded = np.concatenate([[False], same, [False]])
        names, starts, last = merge(same & ~padded[:-2] & ~padded[2:], names, starts, last)
    for r in (1, 2):
        if len(names) > 1:
            right = (mixed(names + np.uint64(r)) & np.uint64(1)).astype(bool)
            names, starts, last = merge(~right[:-1] & right[1:] & ~last[:-1], names, starts, last)
    return names, starts


def window_anchors(names: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The anchor's place for every window start of the joined documents, and which starts hold a whole window."""
    n = len(names)
    bounds = np.cumsum(sizes)
    ends = np.zeros(n, bool)
    ends[bounds[bounds > 0] - 1] = True
    symbols, starts = recompress(names, ends)
    value = np.full(n + 1, np.iinfo(np.uint64).max, np.uint64)
    value[starts] = mixed(symbols)
    at, width = np.arange(n, dtype=np.int64), 1
    while width < REACH:  # leftmost least value of growing stretches
        step = min(width, REACH - width)
        right = at[step:]
        left = at[: len(right)]
        at = np.where(value[left] <= value[right], left, right)
        width += step
    room = np.zeros(n, bool)
    begin = 0
    for size, end in zip(sizes, bounds.tolist()):
        room[begin : max(begin, end - WINDOW + 1)] = True
        begin = end
    windows = np.flatnonzero(room)
    return windows, at[windows + LOST] if len(windows) else windows


def anchor_keys(names: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, their anchors' places, and the anchors' keys."""
    windows, places = window_anchors(names, sizes)
    return windows, places, mixed(span_hash(names, BASES[0], places, *AROUND))


def chunks(rows: Iterator[tuple], names: WordNames) -> Iterator[tuple[list, np.ndarray, list[int]]]:
    """Rows (data first) in groups of bounded word count, with the joined word names and word counts."""
    held, parts, n = [], [], 0
    for row in rows:
        words = (row[0] or b"").split()
        if held and n + len(words) > CHUNK:
            yield held, np.concatenate(parts), [len(p) for p in parts]
            held, parts, n = [], [], 0
        held.append(row)
        parts.append(np.fromiter(map(names.__getitem__, words), np.uint64, len(words)))
        n += len(words)
    if held:
        yield held, np.concatenate(parts), [len(p) for p in parts]


def row_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def schemas(spec: str, *first: StructField) -> tuple[StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([*first, *_parse_datatype_string(spec).fields])
    return schema, to_arrow_schema(schema)


def folded(docs: DataFrame) -> DataFrame:
    """Per row: key (digest of the text), digest of the words, their number, and the keys of its anchors."""
    schema, out = schemas("key string, digest string, n_words long, anchors array<long>",
                          StructField("doc_id", docs.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, result = batch.column(0), []
            for held, names, sizes in chunks(zip(batch.column(1).to_pylist()), word_names()):
                windows, places, keys = anchor_keys(names, sizes)
                new = np.ones(len(places), bool)
                new[1:] = places[1:] != places[:-1]
                windows, keys = windows[new], keys[new]
                cut = np.searchsorted(windows, np.cumsum([0, *sizes]))
                for k, (data,) in enumerate(held):
                    data = data or b""
                    own = np.unique(keys[cut[k] : cut[k + 1]]).view(np.int64)
                    result.append((hashlib.sha256(data).hexdigest(), hashlib.sha256(b" ".join(data.split())).hexdigest(), sizes[k], own))
            columns = list(zip(*result)) if result else [()] * 4
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(list(c), out.field(i + 1).type) for i, c in enumerate(columns)]], schema=out)

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def arrow_rows(result: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*result)) if result else [()] * len(out)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, out)], schema=out)


def shared_spans(texts: DataFrame) -> DataFrame:
    """Per document the spans of its windows with a key among the row's ``hits``.

    A span is all consecutive windows with one anchor: key, content hash (128 bits), first start, number of windows.
    """
    schema, out = schemas("digest string, text binary, keys array<long>, s1 array<long>, s2 array<long>, starts array<int>, counts array<int>",
                          StructField("doc_id", texts.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()  # repeated rows of one document add nothing
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), *[batch.column(c).to_pylist() for c in ("doc_id", "digest")], batch.column("hits"))
            for held, names, sizes in chunks(rows, word_names()):
                windows, places, keys = anchor_keys(names, sizes)
                offsets = np.cumsum([0, *sizes])
                cut, result = np.searchsorted(windows, offsets), []
                for k, (data, doc, digest, hits) in enumerate(held):
                    if digest in seen:
                        continue
                    seen.add(digest)
                    own = slice(cut[k], cut[k + 1])
                    known = np.isin(keys[own], hits.values.to_numpy(zero_copy_only=False).view(np.uint64))
                    starts, at = windows[own][known], places[own][known]
                    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool))
                    count = np.diff(np.concatenate([first, [len(at)]]))
                    begin = starts[first]
                    hashes = [mixed(span_hash(names, b, begin, 0, count + WINDOW - 1) + count.astype(np.uint64)).view(np.int64) for b in BASES]
                    result.append((doc, digest, data, keys[own][known][first].view(np.int64), *hashes,
                                   (begin - offsets[k]).astype(np.int32), count.astype(np.int32)))
                yield arrow_rows(result, out)

    return texts.select("doc_id", "digest", "text", "hits").mapInArrow(run, schema)


def window_hashes(texts: DataFrame) -> DataFrame:
    """One row per window of the row's ``open`` spans: rid, doc_id, start and 128-bit hash."""
    schema, out = schemas("start int, h1 long, h2 long", StructField("rid", LongType()), StructField("doc_id", texts.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows = zip(batch.column("text").to_pylist(), batch.column("rid").to_pylist(), range(len(ids)), batch.column("open").to_pylist())
            for held, names, sizes in chunks(rows, word_names()):
                at, parts = 0, []
                for (_, rid, place, spans), size in zip(held, sizes):
                    starts = np.concatenate([np.arange(s["start"], s["start"] + s["count"]) for s in spans])
                    parts.append((np.full(len(starts), rid), np.full(len(starts), place), starts, starts + at))
                    at += size
                rid, place, starts, absolute = (np.concatenate(x) for x in zip(*parts))
                hashes = [mixed(span_hash(names, b, absolute, 0, WINDOW)).view(np.int64) for b in BASES]
                yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), ids.take(pa.array(place)), pa.array(starts.astype(np.int32)),
                                                  *map(pa.array, hashes)], schema=out)

    return texts.select("rid", "doc_id", "text", "open").mapInArrow(run, schema)


def kept_texts(found: DataFrame) -> DataFrame:
    """Per digest: words removed, digest of the kept words, and the kept text (runs of kept words, one a line)."""
    schema, out = schemas("digest string, n_removed long, kept_sha256 string, kept_text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = []
            for digest, data, spans_of in zip(*[batch.column(c).to_pylist() for c in ("digest", "text", "covered")]):
                spans = [m.span() for m in WORD.finditer(data)]
                delta = np.zeros(len(spans) + 1, np.int64)
                for span in spans_of:
                    delta[span["start"]] += 1
                    delta[span["start"] + span["count"] + WINDOW - 1] -= 1
                stay = delta[:-1].cumsum() == 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], stay.view(np.int8), [0]])))
                runs = [data[spans[a][0] : spans[b - 1][1]] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                words = b" ".join(w for r in runs for w in r.split())
                result.append((digest, int((~stay).sum()), hashlib.sha256(words).hexdigest(), b"\n".join(runs).decode()))
            columns = list(zip(*result)) if result else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return found.select("digest", "text", "covered").mapInArrow(run, schema)


def repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, key, n_words, n_removed, kept_sha256, kept_text (null: nothing removed)."""
    rows = written(folded(docs), "folded")
    long = rows.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW))
    first = written(
        long.groupBy("digest").agg(F.min(F.struct("doc_id", "key")).alias("r"), F.first("anchors").alias("anchors"))
        .select("digest", F.col("r.doc_id").alias("first_id"), F.col("r.key").alias("first_key"), "anchors")
        .withColumn("rid", F.monotonically_increasing_id()),
        "first-copies",
    )
    keys = first.select(F.explode("anchors").alias("anchor"), "first_id", "rid")
    shared = keys.groupBy("anchor").agg(F.min("first_id").alias("lo"), F.max("first_id").alias("hi")).filter("lo < hi").select("anchor")
    hits = keys.select("anchor", "rid").join(shared, "anchor").groupBy("rid").agg(F.collect_list("anchor").alias("hits"))
    hits = hits.join(first.select("rid", "digest", "first_id", "first_key"), "rid").drop("rid")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), row_key(F.col("text")).alias("key"))
    joined = texts.join(hits, (F.col("doc_id") == F.col("first_id")) & (F.col("key") == F.col("first_key")))
    found = written(shared_spans(joined).withColumn("rid", F.monotonically_increasing_id()), "shared-spans")
    each = found.select("rid", "doc_id", F.explode(F.arrays_zip("keys", "s1", "s2", "starts", "counts")).alias("w")).select(
        "rid", "doc_id", "w.keys", "w.s1", "w.s2", F.col("w.starts").alias("start"), F.col("w.counts").alias("count"))
    # equal spans: all but those of the smallest id are covered as a whole, and that one speaks for their windows
    same = ["keys", "s1", "s2"]
    kinds = written(each.groupBy(*same).agg(F.min("doc_id").alias("lo")), "span-kinds")
    ruled = each.join(kinds, same)
    whole = ruled.filter("lo < doc_id").select("rid", F.struct("start", "count").alias("span"))
    # only where a key has different spans can a window be shared beyond its span
    mixed_keys = kinds.groupBy("keys").agg(F.count("*").alias("n")).filter("n > 1").select("keys")
    undecided = (ruled.filter("lo = doc_id").join(mixed_keys, "keys")
                 .groupBy("rid").agg(F.collect_list(F.struct("start", "count")).alias("open")))
    windows = written(window_hashes(found.select("rid", "doc_id", "text").join(undecided, "rid")), "windows")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("h1", "h2", "lo")
    single = windows.join(least, ["h1", "h2"]).filter("lo < doc_id").select("rid", F.struct("start", F.lit(1).alias("count")).alias("span"))
    covered = whole.unionByName(single).groupBy("rid").agg(F.collect_list("span").alias("covered"))
    cut = kept_texts(found.select("rid", "digest", "text").join(covered, "rid")).groupBy("digest").agg(
        *[F.first(c).alias(c) for c in ("n_removed", "kept_sha256", "kept_text")]
    )
    known = first.select("digest", "first_id").join(cut, "digest", "left")
    copy = F.col("doc_id") > F.col("first_id")
    hit = F.col("doc_id") == F.col("first_id")
    return rows.drop("anchors").join(known, "digest", "left").select(
        "doc_id", "key", "n_words",
        F.when(copy, F.col("n_words")).when(hit, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).when(hit, F.coalesce("kept_sha256", "digest")).otherwise(F.col("digest")).alias("kept_sha256"),
        F.when(copy, F.lit("")).when(hit, F.col("kept_text")).alias("kept_text"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text``; every row stays, wholly repeated ones with empty text."""
    cut = repeats(docs).filter("n_removed > 0").groupBy("doc_id", "key").agg(F.first("kept_text").alias("_kept"))
    cut = cut.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_kept")
    joined = docs.join(cut, (F.col("doc_id") == F.col("_id")) & (row_key(F.col("text")) == F.col("_key")), "left")
    return with_new(joined.drop("_id", "_key"), {"text": F.coalesce("_kept", "text")}).drop("_kept").select(*docs.columns)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word windows that start in a document with a smaller id."""
    return repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
