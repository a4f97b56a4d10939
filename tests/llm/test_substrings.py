import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyworks.llm import substrings
from tallyworks.llm.queries import SQL
from tests.llm.conftest import SF

W = 50


def brute(docs):
    """(n_words, n_removed, sha) per position of (doc_id, text)."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    least = {}
    for (d, _), words in zip(docs, split):
        for i in range(len(words) - W + 1 if d is not None else 0):
            w = tuple(words[i : i + W])
            least[w] = min(d, least.get(w, d))
    out = []
    for (d, _), words in zip(docs, split):
        gone = set()
        for i in range(len(words) - W + 1 if d is not None else 0):
            if least[tuple(words[i : i + W])] < d:
                gone.update(range(i, i + W))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_query_against_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [tuple(r) for r in substrings.op6_substrings(spark, SF).collect()]
    assert order(rows) == order(brute(docs)) and sum(r[2] for r in rows) > 0


def planted(rng, n=120):
    """Small alphabets, runs and periods, so that windows begin and end inside every kind of symbol."""
    passages = [[rng.choice("abc") for _ in range(70)], ["a"] * 80, ["a", "b"] * 40, [f"w{i}" for i in range(60)],
                [x for i in range(20) for x in [f"r{i}"] * rng.randint(1, 5)], [f"v{i}" for i in range(50)]]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            k = rng.randint(0, max(0, len(p) - 45))
            words += p[k : k + rng.randint(45, 80)] if rng.random() < 0.7 else [rng.choice("abcdexyz") for _ in range(rng.randint(1, 60))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return texts


def test_planted_repeats(docs_of):
    texts = planted(random.Random(6))
    docs = docs_of(texts, digest="x", key=1, n_removed="y")
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeats(docs).collect()]
    assert order(rows) == order(brute(list(enumerate(texts))))
    out = {r.doc_id: r.text for r in substrings.without_repeats(docs).collect()}
    assert {(d, hashlib.sha256(" ".join(out[d].split()).encode()).hexdigest()) for d in out} == {(r[0], r[3]) for r in rows}
    assert all(out[r[0]] == texts[r[0]] for r in rows if not r[2])


def test_inside_of_a_window_is_named_alike():
    """The claim behind the anchors: same window, same anchor, whatever surrounds it."""
    rng = random.Random(7)
    names = np.array([rng.getrandbits(64) for _ in range(4)], np.uint64)
    for trial in range(400):
        kinds = [[rng.randrange(4) for _ in range(W)], [trial % 4] * W, [0, 1] * 25, [k // 3 % 4 for k in range(W)]]
        window = names[kinds[trial % 4]]
        found = set()
        for _ in range(4):
            left, right = (names[[rng.randrange(4) for _ in range(rng.randint(0, 20))]] if k else names[[window_edge] * rng.randint(0, 9)]
                           for k, window_edge in ((trial % 3, 0), (trial % 2, 1)))
            joined = np.concatenate([left, window, right]).astype(np.uint64)
            windows, places, keys = substrings.anchor_keys(joined, [len(joined)])
            found.add((int(places[len(left)]) - len(left), int(keys[len(left)])))
        assert len(found) == 1


def test_odd_rows(docs_of, odd_texts):
    long = " ".join(f"t{i}" for i in range(60))
    texts = [*odd_texts, long, long + " more", long.replace(" ", "\n"), odd_texts[13]]
    docs = docs_of(texts)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 22, F.lit(None)).otherwise(F.col("doc_id")))
    docs = docs.unionAll(docs.filter("doc_id = 20")).unionAll(docs.filter("doc_id = 21").withColumn("text", F.lit("other " + long)))
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeats(docs).collect()]
    assert order(rows) == order(brute([(r.doc_id, r.text) for r in docs.collect()]))
    assert substrings.repeats(docs.filter("false")).collect() == []
    assert substrings.without_repeats(docs.filter("false")).collect() == []
    assert substrings.without_repeats(docs).count() == docs.count()


def test_query_matches_sql(spark):
    """The SQL is another way to the same words: it compares whole passages."""
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = connection.execute(SQL["op6_substrings"]).fetchall()
    found = [tuple(row) for row in substrings.op6_substrings(spark, SF).collect()]
    assert sorted(found) == sorted(expected) and any(row[2] for row in found)


def test_sql_on_edge_rows(spark, odd_texts):
    passage = " ".join(f"w{i % 17}" for i in range(60))
    texts = [*odd_texts, passage, f"lead {passage}  tail", None, passage]
    rows = pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)})
    connection = duckdb.connect()
    connection.register("documents", rows)
    expected = connection.execute(SQL["op6_substrings"]).fetchall()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = [tuple(r) for r in substrings.repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(found) == sorted(expected)
