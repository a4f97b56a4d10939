import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import vector_codes as vc
from tests.llm.conftest import SF


def plain(rows, rounds=4):
    """(vec_id, code, error, label error, digest) by full scans with Python's whole numbers."""
    kept = [(i, [math.floor(1024 * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = len(kept[0][1]) // 4
    parts = [[v[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(4)]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0], kept[r][1]))[:256]
    books = [[parts[p][r] for r in first] for p in range(4)]

    def nearest(y, book):
        return min((sum((a - b) ** 2 for a, b in zip(y, entry)), e) for e, entry in enumerate(book))

    for step in range(rounds + 1):
        found = [[nearest(y, books[p]) for y in parts[p]] for p in range(4)]
        if step == rounds:
            break
        for p in range(4):
            for e in range(len(books[p])):
                own = [y for y, (_, k) in zip(parts[p], found[p]) if k == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    errors = [sum(found[p][r][0] for p in range(4)) for r in range(len(kept))]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    return sorted((kept[r][0], "".join(f"{found[p][r][1]:02x}" for p in range(4)), errors[r], by_label[kept[r][2]], digest) for r in range(len(kept)))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = vc.op12_codes(spark, SF)
    assert found.columns == [d[0] for d in duck.execute(vc.sql()).description]
    assert rows_of(found) == sorted(duck.execute(vc.sql()).fetchall())


def test_query_matches_plain_loops(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(300).collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert rows_of(vc.encode(df)) == plain(rows)


def drifting(rng, n, length, k):
    centres = rng.integers(-3000, 3000, (k, 4, length))
    return centres[rng.integers(0, k, n)] + rng.integers(-200, 200, (n, 4, length))


@pytest.mark.parametrize("n,length,k", [(3000, 8, 40), (2000, 1, 300), (500, 16, 500), (40, 3, 5)])
def test_bounds_change_nothing_and_save_work(n, length, k):
    """Every round gives the full scan's codes, ties and all; bounds hold and stay below the true distances."""
    rng = np.random.default_rng(n)
    x = drifting(rng, n, length, k)
    history = x[:256].transpose(1, 0, 2)[None]
    known, work = None, []
    for _ in range(6):
        known, errors, computed = vc.assign(x, history, known)
        work.append(computed)
        squares = np.stack([((x[:, p, None, :] - history[-1][p][None]) ** 2).sum(2) for p in range(4)], 1)
        assert (known.codes == squares.argmin(2)).all() and (errors == squares.min(2).sum(1)).all()
        for g, span in enumerate(vc.groups_of(history.shape[2])):
            then = history[known.stamps[:, :, g], np.arange(4)]  # codebooks of the stamps: (n, parts, entries, length)
            rest = np.sqrt(((x[:, :, None, :] - then[:, :, span]) ** 2).sum(3))
            rest[known.codes[:, :, None] == np.arange(span.start, span.stop)] = np.inf
            assert (known.bounds[:, :, g] <= rest.min(2, initial=np.inf)).all()
        counts, totals = np.zeros((4, history.shape[2]), int), np.zeros(history.shape[1:], int)
        for p in range(4):
            np.add.at(counts[p], known.codes[:, p], 1)
            np.add.at(totals[p], known.codes[:, p], x[:, p])
        history = np.concatenate([history, vc.update(history[-1], totals, counts)[None]])
    if n == 3000:
        assert work[-1] < 0.5 * work[0]


def test_net_displacement_beats_added_drifts():
    """An entry that goes and comes back has drifted far, but its bound is lowered by nothing."""
    books = np.zeros((3, 8, 1), np.int64)
    books[:, :, 0] = np.arange(8) * 1000
    books[1, 5, 0] += 400
    x = np.array([[10], [20], [-5]])
    codes, _, bounds, stamps, first = vc.assign_part(x, books[:1], None, None, None)
    _, _, _, late, again = vc.assign_part(x, books, codes, bounds, stamps)
    assert first == 3 * 8 and again == 3 and (late == 0).all()


def test_large_numbers_are_exact():
    x = np.array([[2**28, 1], [-(2**28), 3]])
    entries = np.array([[2**28 - 1, 0], [-(2**28), 0]])
    assert vc.squared(x, entries).tolist() == [[2, (2**29) ** 2 + 1], [(2**29 - 1) ** 2 + 9, 9]]


def test_odd_rows(spark):
    good = [0.5, -0.001, 0.25, 1.0]
    rows = [(1, good, 1), (1, good, 1), (2, None, 1), (3, [0.5, None, 0.25, 1.0], 1), (4, [math.nan] * 4, 1), (5, [math.inf, 0.0, 0.0, 0.0], 1),
            (6, [0.0] * 4, None), (None, [1.0, 1.0, 1.0, 1.0], None), (8, [1e30, 0.0, 0.0, 0.0], 1), (9, [1.0, 2.0, 3.0], 1), (10, [], 2),
            (11, [0.1] * 8, 7), (12, [0.1] * 8, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("x", F.lit(1)).withColumn("size", F.lit("z"))
    found = {}
    for r in vc.encode(df).collect():
        found.setdefault(r.vec_id, []).append(r)
    assert set(found) == {1, 6, None, 10, 11, 12} and len(found[1]) == 2
    four = [(1, good, 1), (1, good, 1), (6, [0.0] * 4, None), (99, [1.0] * 4, None)]
    expected = {i: (code, error) for i, code, error, _, _ in plain(four)}
    assert {99 if i is None else i: (r[0].code, r[0].error) for i, r in found.items() if i in (1, 6, None)} == expected
    assert found[1][0].codebooks_sha256 == plain(four)[0][4] != found[11][0].codebooks_sha256
    assert found[10][0].error == 0 and found[11][0].code == "00000000" and found[11][0].error == 0
    assert found[6][0].label_error == found[None][0].label_error
    none = df.filter("false")
    assert vc.encode(none).collect() == [] and vc.encode(df.filter("vec_id = 2")).collect() == []
