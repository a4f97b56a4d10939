"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Vectors are whole numbers here (floor of 1024 times a component), cut into equal parts; all sums and distances are exact. A round
assigns every part to the nearest entry of its position's codebook and moves the entries to the floors of their parts' means.
Most distances need not be computed: for each group of entries a part keeps a lower bound of the distance to any of them but its own, with the
round it was measured in (its stamp). Codebooks of all rounds are kept, so that a bound is lowered by how far the group's entries really
are from where they were in that round, which is at most the sum of their drifts since. Only groups whose bound does not
exceed the distance to the part's own entry are scanned, exactly.

A round is one narrow pass over the table of vectors and their bounds, written for the next round, and one pass that adds up 256 entries
a part in each task. The driver holds the codebooks only.

Edge cases: vectors that are null or hold a null or non-finite component take no part, nor do those whose length is no multiple
of the parts or whose squared distances would not fit a long (components beyond about 180,000 with 64 of them). Vectors of each length have their own
codebooks, an empty vector has error 0. With fewer vectors than entries a codebook has as many entries as vectors. Seeds of one id are taken in
the vectors' order, rows without an id come last; repeated rows are coded alike; labels that are null are summed together; an empty
table gives no rows; columns beside vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.common import table, written
from tallyworks.session import scratch_dir
from tallyworks.sources.listing import remove

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 8  # entries share a bound in as many groups
ROWS = 4096  # vectors that are compared at a time
STATE = "vec_id long, label int, x array<int>, codes binary, bounds binary, stamps binary, error long"
SUMS = "size int, part int, entry int, place int, total long, n long"


@dataclass
class Known:
    """What earlier rounds found out: own entries (n, parts), bounds and their stamps (n, parts, groups)."""

    codes: np.ndarray
    bounds: np.ndarray
    stamps: np.ndarray


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to entries; by products where those fit a double exactly."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        out[:, k] = ((x - entry) ** 2).sum(1)
    return out


def at_least(squares: np.ndarray) -> np.ndarray:
    """A float at most the root of each number; infinite where there is none (the largest long)."""
    roots = np.sqrt(squares.astype(np.float64)) * (1 - 1e-12)
    down = np.nextafter(roots.astype(np.float32), np.float32(-np.inf))
    return np.where(squares == NONE, np.float32(np.inf), down)


def at_most(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + 1e-12)


NONE = np.iinfo(np.int64).max


def groups_of(entries: int) -> list[slice]:
    cuts = [entries * g // GROUPS for g in range(GROUPS + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def two_least(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the least of each row (the first of equals), the least, and the least of the others."""
    rows = np.arange(len(squares))
    place = squares.argmin(1)
    least = squares[rows, place]
    rest = squares.copy()
    rest[rows, place] = NONE
    return place, least, rest.min(1)


def assign_part(x: np.ndarray, history: np.ndarray, codes: np.ndarray | None, bounds: np.ndarray | None, stamps: np.ndarray | None):
    """Nearest entries of one part position after ``len(history) - 1`` rounds: codes, squared distances, bounds, stamps, and how
    many distances were computed. ``history`` (rounds, entries, length) holds the codebook of every round."""
    now, here = history[-1], len(history) - 1
    spans, n = groups_of(len(now)), len(x)
    first = codes is None
    if first:
        codes, bounds, stamps = np.zeros(n, np.int64), np.zeros((n, GROUPS), np.float32), np.zeros((n, GROUPS), np.uint8)
        own = np.full(n, NONE)
        need = np.ones((n, GROUPS), bool)
        computed = 0
    else:
        codes, bounds, stamps = codes.astype(np.int64), bounds.copy(), stamps.copy()
        own = ((x - now[codes]) ** 2).sum(1)
        moved = at_most(((history - now) ** 2).sum(2))  # of every entry since every round
        net = np.array([[m[s].max(initial=0) for s in spans] for m in moved])
        need = bounds - net[stamps, np.arange(GROUPS)] <= at_most(own)[:, None]
        computed = n
    best, at = own.copy(), codes.copy()
    place = np.full((n, GROUPS), -1)
    least, second = np.full((n, GROUPS), NONE), np.full((n, GROUPS), NONE)

    def scan(g: int, rows: np.ndarray) -> int:
        span = spans[g]
        if len(rows) == 0 or span.start == span.stop:
            return 0
        k, a, b = two_least(squared(x[rows], now[span]))
        place[rows, g], least[rows, g], second[rows, g] = k + span.start, a, b
        return len(rows) * (span.stop - span.start)

    for g in range(GROUPS):
        rows = np.flatnonzero(need[:, g])
        computed += scan(g, rows)
        better = (least[rows, g] < best[rows]) | ((least[rows, g] == best[rows]) & (place[rows, g] < at[rows]) & (place[rows, g] >= 0))
        best[rows[better]], at[rows[better]] = least[rows[better], g], place[rows[better], g]
    if not first:
        # an entry that is left counts for its group's bound again
        for g, span in enumerate(spans):
            left = np.flatnonzero((at != codes) & (codes >= span.start) & (codes < span.stop) & ~need[:, g])
            computed += scan(g, left)
            need[left, g] = True
    others = np.where(place == at[:, None], second, least)
    bounds[need] = at_least(others)[need]
    stamps[need] = here
    return at, best, bounds, stamps, computed


def assign(x: np.ndarray, history: np.ndarray, known: Known | None) -> tuple[Known, np.ndarray, int]:
    """Codes, bounds and stamps of vectors (n, parts, length), their errors, and how many distances were computed."""
    n = len(x)
    out = Known(np.zeros((n, PARTS), np.uint8), np.zeros((n, PARTS, GROUPS), np.float32), np.zeros((n, PARTS, GROUPS), np.uint8))
    errors, computed = np.zeros(n, np.int64), 0
    for p in range(PARTS):
        before = (None, None, None) if known is None else (known.codes[:, p], known.bounds[:, p], known.stamps[:, p])
        codes, squares, out.bounds[:, p], out.stamps[:, p], some = assign_part(x[:, p], history[:, p], *before)
        out.codes[:, p] = codes
        errors += squares
        computed += some
    return out, errors, computed


def update(codebooks: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries moved to the floors of their parts' means; unused ones stay."""
    return np.where(counts[:, :, None] > 0, totals // np.maximum(counts, 1)[:, :, None], codebooks)


def rows_by_size(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one vector length and those vectors, at most ``ROWS`` at a time."""
    sizes = batch.column("x").value_lengths().to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for start in range(0, len(rows), ROWS):
            part = batch.take(pa.array(rows[start : start + ROWS]))
            flat = part.column("x").flatten().to_numpy().astype(np.int64)
            yield part, flat.reshape(part.num_rows, PARTS, int(size) // PARTS)


def fixed(values: np.ndarray) -> pa.Array:
    """Rows of an array as binary values."""
    width = values[0].nbytes if len(values) else 0
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def loose(column: pa.Array, kind, shape: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, *shape)


def round_of(state: DataFrame, history: dict[int, np.ndarray]) -> DataFrame:
    """One assignment of all vectors; ``history`` holds the codebooks (rounds, parts, entries, length) by vector length."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(STATE)
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in rows_by_size(batch):
                known = None
                if "codes" in part.schema.names:
                    known = Known(loose(part.column("codes"), np.uint8, (PARTS,)), loose(part.column("bounds"), np.float32, (PARTS, GROUPS)),
                                  loose(part.column("stamps"), np.uint8, (PARTS, GROUPS)))
                found, errors, _ = assign(x, history[x.shape[1] * x.shape[2]], known)
                same = [part.column(c).cast(out.field(c).type) for c in ("vec_id", "label", "x")]
                yield pa.RecordBatch.from_arrays([*same, fixed(found.codes), fixed(found.bounds), fixed(found.stamps), pa.array(errors)], schema=out)

    return state.mapInArrow(run, schema)


def sums_of(state: DataFrame) -> DataFrame:
    """Sums and counts of the parts of each entry, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in rows_by_size(batch):
                codes = loose(part.column("codes"), np.uint8, (PARTS,)).astype(np.int64) + np.arange(PARTS) * ENTRIES
                length = x.shape[2]
                own = totals.setdefault(PARTS * length, np.zeros((PARTS * ENTRIES, length), np.int64))
                np.add.at(own, codes.ravel(), x.reshape(len(x) * PARTS, length))
                counts.setdefault(PARTS * length, np.zeros(PARTS * ENTRIES, np.int64))[:] += np.bincount(codes.ravel(), minlength=PARTS * ENTRIES)
        for size, own in totals.items():
            used = np.flatnonzero(counts[size])
            length = own.shape[1]
            rows, places = np.repeat(used, length), np.tile(np.arange(length), len(used))
            columns = [np.full(len(rows), size), rows // ENTRIES, rows % ENTRIES, places, own[rows, places], counts[size][rows]]
            kinds = [pa.int32()] * 4 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["size", "part", "entry", "place", "total", "n"])

    parts = state.select("x", "codes").mapInArrow(run, SUMS)
    return parts.groupBy("size", "part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the vector in whole numbers of the rows that take part."""
    v = F.col("v")
    length = F.greatest(F.size(v) / PARTS, F.lit(1.0))
    limit = F.sqrt(F.lit(2.0**59) / length)
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                            F.col("embedding").cast("array<double>").alias("v"))
    near = narrow.withColumn("limit", limit).filter(
        v.isNotNull() & (F.size(v) % PARTS == 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < F.col("limit"))))

    def whole(c: Column) -> Column:
        return F.floor(c * SCALE).cast("int")

    return near.select("vec_id", "label", F.transform(v, whole).alias("x"))


def seeds(rows: DataFrame) -> dict[int, np.ndarray]:
    """First codebooks (1, parts, entries, length) by vector length: the parts of the rows with the smallest ids."""
    sized = rows.select(F.size("x").alias("size"), "vec_id", "x")
    order = Window.partitionBy("size").orderBy(F.col("vec_id").asc_nulls_last(), "x")
    first = sized.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= ENTRIES).orderBy("size", "k").collect()
    by_size: dict[int, list] = {}
    for row in first:
        by_size.setdefault(row["size"], []).append(row["x"])
    return {size: np.array(x, np.int64).reshape(len(x), PARTS, size // PARTS).transpose(1, 0, 2)[None] for size, x in by_size.items()}


def trained(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The written table of all coded vectors and the history of codebooks by vector length, the final ones last."""
    spark = vectors.sparkSession
    state = written(whole_numbers(vectors), "vectors")
    history = seeds(state)
    old = None
    for step in range(rounds + 1):
        path = scratch_dir(spark, f"codes-{step}")
        round_of(state, history).write.parquet(path)
        state = spark.read.schema(STATE).parquet(path)
        if old:
            remove(spark, old)  # the bounds of a finished round are not needed any more
        old = path
        if step < rounds:
            totals = {size: np.zeros((PARTS, ENTRIES, size // PARTS), np.int64) for size in history}
            counts = {size: np.zeros((PARTS, ENTRIES), np.int64) for size in history}
            for row in sums_of(state).collect():  # as many rows as a codebook has components
                totals[row["size"]][row["part"], row["entry"], row["place"]] = row["total"]
                counts[row["size"]][row["part"], row["entry"]] = row["n"]
            for size, books in history.items():
                entries = books.shape[2]
                moved = update(books[-1], totals[size][:, :entries], counts[size][:, :entries])
                history[size] = np.concatenate([books, moved[None]])
    return state, history


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the codebooks of every vector that takes part."""
    state, history = trained(vectors, rounds)
    names = vectors.sparkSession.createDataFrame([(size, digest(books[-1])) for size, books in history.items()], "size int, codebooks_sha256 string")
    coded = state.select("vec_id", "label", F.size("x").alias("size"), F.lower(F.hex("codes")).alias("code"), "error")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).join(names, "size")
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    return encode(table(spark, sf_dir, "embeddings"))


def sql(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> str:
    """The same in DuckDB's SQL, every distance computed. Products and sums stay below 2^53, so doubles hold them exactly."""
    steps = [f"""kept AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
      cut AS (SELECT r, p, list_slice(x, p * len(x) // {parts} + 1, (p + 1) * len(x) // {parts}) AS y
        FROM kept, range({parts}) AS _(p)),
      sized AS (SELECT *, list_inner_product(y, y) AS yy FROM cut),
      seed AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY row_number() OVER (ORDER BY vec_id) <= {entries}),
      book0 AS (SELECT p, e, y AS b FROM seed JOIN cut USING (r))"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT r, p, min((d, e)) AS hit FROM (
          SELECT r, p, e, yy - 2 * list_inner_product(y, b) + list_inner_product(b, b) AS d FROM sized JOIN book{k} USING (p)) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (SELECT p, e, list(m ORDER BY i) AS b FROM (SELECT p, e, i, floor(sum(c) / count(*)) AS m FROM (
              SELECT p, hit[2] AS e, unnest(y) AS c, generate_subscripts(y, 1) AS i FROM near{k} JOIN cut USING (r, p)) GROUP BY p, e, i) GROUP BY p, e),
          book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.b, o.b) AS b FROM book{k} o LEFT JOIN mean{k} n USING (p, e))""")
    return f"""WITH {", ".join(steps)},
      coded AS (SELECT r, string_agg(printf('%02x', hit[2]::INTEGER), '' ORDER BY p) AS code, sum(hit[1])::BIGINT AS error FROM near{rounds} GROUP BY r),
      books AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS s FROM (
        SELECT p, e, unnest(b) AS c, generate_subscripts(b, 1) AS i FROM book{rounds}))
      SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
      FROM kept JOIN coded USING (r), books"""
