import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import lexical
from tests.llm.conftest import SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, items, k=10):
    """Lists by item row, every document scored."""
    bags = []
    for i, text in docs:
        bag = {}
        for t in TERM.findall((text or "").translate(LOWER)):
            bag[t] = bag.get(t, 0) + 1
        if bag:
            bags.append((i, bag, sum(bag.values())))
    n, total = len(bags), sum(b[2] for b in bags)
    df = {}
    for _, bag, _ in bags:
        for t in bag:
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, bag, length in bags:
            m = 100 - 90 + (90 * length * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(LOWER))) if t in bag)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_query_matches_sql_and_loops(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = lexical.op13_search(spark, SF)
    cursor = duck.execute(lexical.SQL)
    assert found.columns == [d[0] for d in cursor.description]
    rows = rows_of(found)
    assert rows == ordered(cursor.fetchall())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert rows == ordered(plain(docs, items))


@pytest.mark.parametrize("bundle,docs,block", [(3, 16, 1 << 20), (256, 7, 60)])
def test_many_slices_bundles_and_blocks(spark, bundle, docs, block):
    rng = np.random.default_rng(docs)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "a1"]
    chance = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 30), p=chance / chance.sum())) for _ in range(150)]
    data = [(i, t) for i, t in enumerate(texts)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 8)))) for i in range(11)]
    a = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(lexical.ranked(a, b, 5, bundle, docs, block)) == ordered(plain(data, items, 5))


def test_pruning_is_safe_and_saves():
    """With a bound on what is to come, bundles shrink, and what leaves could not have come back."""
    rng = np.random.default_rng(1)
    n, size = 2000, 40
    q = lexical.Query([0], [np.arange(size)], {}, docs=n, total=n * 50)
    q.weights = np.sort(rng.integers(1, 9000, size))[::-1].copy()
    q.owners = np.arange(size) * 4 // size
    lengths = rng.integers(20, 80, n)
    lists = [np.sort(rng.choice(n, int(n * min(0.9, 0.01 + 0.02 * t)), replace=False)) for t in range(size)]
    tfs = [rng.integers(1, 4, len(x)) for x in lists]
    q.bounds = q.weights * (3 * 10**9 // (3000 + 8 * 10))
    whole = np.zeros(n, np.int64)
    m = 10 + 90 * lengths * n // q.total
    for t in range(size):
        whole[lists[t]] += q.weights[t] * (10**9 * tfs[t] // (1000 * tfs[t] + 8 * m[lists[t]]))
    carried, held = (np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.ones(1, np.uint8)), []
    for stage in range(4):
        own = np.flatnonzero(q.owners == stage)
        part = (own, np.cumsum([len(lists[t]) for t in own]), np.concatenate([lists[t] for t in own]), np.concatenate([tfs[t] for t in own]))
        ((item, docs, scores, opened),) = lexical.added(q, stage, 0, carried, lengths, part, 10)
        carried = (np.full(len(docs), item), docs, scores, np.array([opened], np.uint8))
        held.append(len(docs))
    best = np.lexsort((np.arange(n), -whole))[:10]
    order = np.lexsort((docs, -scores))[:10]
    assert docs[order].tolist() == best.tolist() and scores[order].tolist() == whole[best].tolist()
    assert held[-1] < n / 4


def test_odd_rows(spark, odd_texts):
    data = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "one two"), (None, "one"), (3, "one"), (3, "one"), (50, "ONE one ONE"), (51, "a\x7fb{c}d`e")]
    items = [(1, "One two a b e"), (1, "One two a b e"), (2, None), (3, " .,; "), (4, "naïve 日本語 ΣΑΣ"), (None, "same"), (6, "zzz"), (7, "text " * 5000)]
    a = spark.createDataFrame(data, "doc_id int, text string").withColumn("slice", F.lit("x")).withColumn("score", F.lit(1))
    b = spark.createDataFrame(items, "item_id int, text string").withColumn("terms", F.lit(1)).withColumn("rank", F.lit(1))
    assert rows_of(lexical.ranked(a, b)) == ordered(plain(data, items))
    for x, y in ((a.filter("false"), b), (a, b.filter("false")), (a.filter("text IS NULL"), b), (a, b.filter("item_id IN (2, 3)"))):
        assert lexical.ranked(x, y).collect() == []
