"""Ranked lexical search by pipelined term partitioning.

One pass over the documents cuts them into slices of bounded size and writes, for each slice, the postings of the terms that any
item holds. The terms are owned by a few stages, those of greatest weight by the first. Items travel in bundles from stage to stage,
one copy of a bundle for each slice, and carry sparse accumulators: the documents of the slice that have a score so far. A
stage is a cogroup of bundles and its owner's postings; it adds whole-number contributions. What the stages to
come can add at most is known for each item: documents that cannot reach the slice's k-th best score any more leave the bundle, and a
bundle that no new document can enter with success is closed for them. Both leave every result as it is. After
the last stage the best of each slice are ranked together.

Items are dealt into blocks of bounded numbers of terms, and each block is searched for itself, so that the terms' numbers and weights,
which every task holds, have a bound. A group of a cogroup is one slice and one bundle.

Edge cases: null texts hold no term; texts without a term are not counted, and items without one have no rows; every row of either table
counts for itself, so repeated documents hold ranks of their own, and repeated items have lists of their own; equal scores go by ascending id,
null ids last; empty tables give no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import table, written

TOP = 10
OWNERS = 4  # stages
BUNDLE = 256  # items that travel together
BLOCK_TERMS = 1 << 20  # terms of a block's items, with repeats over items
SLICE_DOCS, SLICE_TOKENS = 16_384, 4_000_000  # documents of a slice, and occurrences of items' terms in it
#: Bytes of terms as they are, A-Z lower-cased, and all others as spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
POSTINGS = "slice long, docs long, terms long, ids binary, named binary, lengths binary, term binary, ends binary, doc binary, tf binary, most binary"
PARTS = "slice long, bundle int, ids binary, named binary, lengths binary, term binary, ends binary, doc binary, tf binary"
BUNDLES = "slice long, bundle int, item binary, doc binary, score binary, open binary"
BEST = "item int, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text with repeats: runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(TERM_BYTES).split()


def blob(values, kind) -> bytes:
    return np.asarray(values, kind).tobytes()


def ints(data: bytes | None, kind=np.int32) -> np.ndarray:
    return np.frombuffer(data or b"", kind)


@dataclass
class Query:
    """A block of items with what every stage must know of them and of the corpus."""

    item_ids: list
    items: list[np.ndarray]  # numbers of the item's different terms
    numbers: dict[bytes, int]
    bundle: int = BUNDLE
    slice_docs: int = SLICE_DOCS
    docs: int = 0
    total: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    owners: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    bounds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # largest contribution of a term

    def later(self, item: int, stage: int) -> int:
        """What the stages after ``stage`` can add to an item's score at most."""
        own = self.items[item]
        return int(self.bounds[own[self.owners[own] > stage]].sum())

    def bundles(self) -> int:
        return -(-len(self.items) // self.bundle)


def cut(part: int, number: int, seen: list[int], ids: list, lengths: list, tokens: list[np.ndarray]) -> tuple:
    """One slice: its counts, documents, and postings in order of term and document."""
    counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
    flat = np.concatenate(tokens).astype(np.int64) if tokens else np.zeros(0, np.int64)
    keys, tf = np.unique(flat * max(1, len(ids)) + np.repeat(np.arange(len(ids)), counts), return_counts=True)
    term, doc = np.divmod(keys, max(1, len(ids)))
    own, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term)) if len(term) else starts
    most = np.maximum.reduceat(tf, starts) if len(term) else tf
    return (part << 32 | number, *seen, blob([i or 0 for i in ids], np.int64), blob([i is not None for i in ids], np.uint8), blob(lengths, np.int64), blob(own, np.int32), blob(ends, np.int32), blob(doc, np.int32), blob(tf, np.int32),
            blob(most, np.int32))


def postings(docs: DataFrame, query: Query) -> DataFrame:
    """Slices of the documents with the postings of the block's terms. Documents without such a term are only counted."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(POSTINGS)
    out = to_arrow_schema(schema)
    numbers = docs.sparkSession.sparkContext.broadcast(query.numbers)
    limit = query.slice_docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, find = TaskContext.get().partitionId(), numbers.value.get
        number, held, seen = 0, 0, [0, 0]
        ids: list = []
        lengths: list[int] = []
        tokens: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            row = cut(part, number, seen, ids, lengths, tokens)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, out)], schema=out)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py())
                if not found:
                    continue
                seen[0] += 1
                seen[1] += len(found)
                own = np.fromiter(map(find, found, repeat(-1)), np.int32, len(found))
                own = own[own >= 0]
                if len(own):
                    ids.append(i)
                    lengths.append(len(found))
                    tokens.append(own)
                    held += len(own)
                if len(ids) >= limit or held >= SLICE_TOKENS:
                    yield done()
                    number, held, seen = number + 1, 0, [0, 0]
                    ids, lengths, tokens = [], [], []
        if seen[0]:
            yield done()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return written(narrow.mapInArrow(run, schema), "postings")


def weigh(slices: DataFrame, query: Query) -> None:
    """Weights, owners and largest contributions of the block's terms, from counts over all documents."""
    query.docs, query.total = (x or 0 for x in slices.agg(F.sum("docs"), F.sum("terms")).first())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for term, ends, most in zip(*(batch.column(c).to_pylist() for c in range(3))):
                yield pa.RecordBatch.from_arrays([pa.array(ints(term)), pa.array(np.diff(ints(ends), prepend=0).astype(np.int64)), pa.array(ints(most))],
                                                 names=["term", "df", "most"])

    counted = slices.select("term", "ends", "most").mapInArrow(count, "term int, df long, most int")
    size = len(query.numbers)
    df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most")).collect():  # the block's terms
        df[row["term"]], most[row["term"]] = row["df"], row["most"]
    n = query.docs
    query.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    least = 100 - 90 + (90 * n) // max(1, query.total)  # of a document of one term
    query.bounds = query.weights * (1_000_000_000 * most // np.maximum(1, 1000 * most + 8 * least))
    # stages own terms of falling weight, with about as many postings each
    order = np.argsort(-query.weights, kind="stable")
    query.owners = np.zeros(size, np.int64)
    query.owners[order] = np.minimum(OWNERS - 1, (np.cumsum(df[order]) - df[order]) * OWNERS // max(1, int(df.sum())))


def owned(slices: DataFrame, query: Query, stage: int, shared) -> DataFrame:
    """The postings of a stage's terms: one row for each slice and bundle."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(PARTS)
    out = to_arrow_schema(schema)
    many = query.bundles()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        wanted = [np.unique(np.concatenate(q.items[b * q.bundle : (b + 1) * q.bundle])) for b in range(many)]
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                number, ids, named, lengths, term, ends, doc, tf = (c[0].as_py() for c in one.columns)
                term, ends, doc, tf = map(ints, (term, ends, doc, tf))
                counts = np.diff(ends, prepend=0)
                mine = q.owners[term] == stage
                for b in range(many):
                    some = mine & np.isin(term, wanted[b]) if many > 1 else mine
                    inside = np.repeat(some, counts)
                    values = (number, b, ids, named, lengths, blob(term[some], np.int32), blob(np.cumsum(counts[some]), np.int32),
                              blob(doc[inside], np.int32), blob(tf[inside], np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, out)], schema=out)

    return slices.select("slice", "ids", "named", "lengths", "term", "ends", "doc", "tf").mapInArrow(run, schema)


def added(q: Query, stage: int, bundle: int, carried: tuple, lengths: np.ndarray, part: tuple, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(item, documents, scores, still open) of a bundle after a stage, in one slice. ``carried`` has items, documents, scores and
    open flags; ``part`` terms, ends, documents and occurrences of the stage's postings."""
    items, docs, scores, opened = carried
    term, ends, doc, tf = part
    m = 100 - 90 + (90 * lengths * q.docs) // max(1, q.total)
    each = np.repeat(q.weights[term], np.diff(ends, prepend=0)) * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m[doc]))
    place = {t: (int(a), int(b)) for t, a, b in zip(term.tolist(), np.append(0, ends[:-1]), ends)}
    first = bundle * q.bundle
    cuts = np.searchsorted(items, np.arange(first, first + q.bundle + 1))
    for j, own in enumerate(q.items[first : first + q.bundle]):
        mine = slice(cuts[j], cuts[j + 1])
        sums = np.zeros(len(lengths), np.int64)
        sums[docs[mine]] = scores[mine]
        for t in own.tolist():
            a, b = place.get(t, (0, 0))
            sums[doc[a:b]] += each[a:b]  # a document occurs once among the postings of a term
        if not opened[j]:
            kept = np.zeros(len(sums), bool)
            kept[docs[mine]] = True
            sums[~kept] = 0
        alive = np.flatnonzero(sums)
        later = q.later(first + j, stage)
        least = int(np.partition(sums[alive], len(alive) - k)[len(alive) - k]) if len(alive) >= k else 0
        alive = alive[sums[alive] + later >= least]
        yield first + j, alive, sums[alive], bool(opened[j]) and later >= least and later > 0


def stage_of(bundles: DataFrame, slices: DataFrame, query: Query, stage: int, shared, k: int) -> DataFrame:
    """Bundles after a stage; after the last one, the k best documents of each item and slice."""
    last = stage == OWNERS - 1

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q = shared.value
        if not len(left) or not len(right):
            return pd.DataFrame({name.split()[0]: [] for name in (BEST if last else BUNDLES).split(", ")})
        a, b = left.iloc[0], right.iloc[0]
        carried = (ints(a["item"]), ints(a["doc"]), ints(a["score"], np.int64), ints(a["open"], np.uint8))
        part = tuple(ints(b[c]) for c in ("term", "ends", "doc", "tf"))
        found = list(added(q, stage, int(a["bundle"]), carried, ints(b["lengths"], np.int64), part, k))
        if not last:
            return pd.DataFrame({"slice": [a["slice"]], "bundle": [a["bundle"]], "item": [blob(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), np.int32)],
                                 "doc": [blob(np.concatenate([f[1] for f in found]), np.int32)],
                                 "score": [blob(np.concatenate([f[2] for f in found]), np.int64)], "open": [blob([f[3] for f in found], np.uint8)]})
        ids, unnamed = ints(b["ids"], np.int64), ints(b["named"], np.uint8) == 0
        rows: list[tuple] = []
        for item, docs, scores, _ in found:
            best = np.lexsort((ids[docs], unnamed[docs], -scores))[:k]
            rows += zip([item] * len(best), ids[docs[best]].tolist(), unnamed[docs[best]].tolist(), scores[best].tolist())
        hits = pd.DataFrame(rows, columns=["item", "doc_id", "unnamed", "score"])
        hits["doc_id"] = hits["doc_id"].astype("Int64").mask(hits.pop("unnamed").astype(bool))
        return hits

    keys = ["slice", "bundle"]
    return bundles.groupBy(*keys).cogroup(owned(slices, query, stage, shared).groupBy(*keys)).applyInPandas(meet, BEST if last else BUNDLES)


def search_block(docs: DataFrame, query: Query, k: int) -> DataFrame:
    """item (its place in the block), doc_id and score of the k best of each slice for each item of a block."""
    slices = postings(docs, query)
    weigh(slices, query)
    shared = docs.sparkSession.sparkContext.broadcast(query)
    many = query.bundles()
    sizes = F.array(*[F.lit(len(query.items[b * query.bundle : (b + 1) * query.bundle])) for b in range(many)])
    empty = F.lit(b"").cast("binary")
    bundles = slices.select("slice", F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("bundle")).select(
        "slice", "bundle", empty.alias("item"), empty.alias("doc"), empty.alias("score"),
        F.unhex(F.repeat(F.lit("01"), sizes[F.col("bundle")])).alias("open"))
    for stage in range(OWNERS):
        bundles = stage_of(bundles, slices, query, stage, shared, k)
    return bundles


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and the item's different terms; items without a term go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.binary())
        for batch in batches:
            own = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, kind)], names=["item_id", "terms"])

    narrow = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    found = narrow.mapInArrow(run, "item_id long, terms array<binary>").filter("size(terms) > 0")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "items")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, bundle: int = BUNDLE, slice_docs: int = SLICE_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each row of ``items``."""
    spark = docs.sparkSession
    found = item_terms(items)
    blocks = max(1, -(-(found.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    best = None
    for block in range(blocks):
        rows = found.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row").collect()  # about block_terms terms
        if not rows:
            continue
        numbers: dict[bytes, int] = {}
        own = [np.array(sorted(numbers.setdefault(bytes(t), len(numbers)) for t in row["terms"]), np.int64) for row in rows]
        query = Query([row["item_id"] for row in rows], own, numbers, bundle, slice_docs)
        hits = search_block(docs, query, k)
        names = spark.createDataFrame([(i, row["row"], row["item_id"]) for i, row in enumerate(rows)], "item int, row long, item_id long")
        named = hits.join(names, "item").select("row", "item_id", "doc_id", "score")
        best = named if best is None else best.unionAll(named)
    if best is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same in DuckDB's SQL.
SQL = r"""WITH low AS (SELECT doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, row_number() OVER () AS r FROM documents),
  found AS (SELECT r, id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
  tfs AS (SELECT r, id, term, count(*) AS tf FROM found GROUP BY ALL),
  lens AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
  corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lens),
  dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
  asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
  scored AS (SELECT item_id, id AS doc_id, r, sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
    FROM asked JOIN tfs USING (term) JOIN dfs USING (term) JOIN lens USING (r), corpus GROUP BY item_id, id, r)
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0 QUALIFY rank <= 10"""
