import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyworks.llm import components, simhash
from tests.llm.conftest import SF


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps, bits):
    """Smallest id reachable, by comparing all pairs."""
    ids, left = sorted(fps), set(fps)
    found = {}
    for i in ids:
        if i not in left:
            continue
        left.discard(i)
        todo = [i]
        while todo:
            a = todo.pop()
            found[a] = i
            near = [b for b in left if (fps[a] ^ fps[b]).bit_count() <= bits]
            left -= set(near)
            todo += near
    return found


def test_query_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    expected = brute(fps, 2)
    rows = simhash.op4_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", expected[i]) for i in fps}


def test_links_against_all_pairs(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = set(centres)
    for c in centres[:12]:  # balls and chains, so that groups are dense
        for _ in range(60):
            c ^= 1 << rng.randrange(64) if rng.random() < 0.5 else (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            values.add(c)
            values.add(c ^ (1 << rng.randrange(8)))
    signed = [int(np.array([v], np.uint64).view(np.int64)[0]) for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.fingerprint_links(distinct, 2)).collect()}
    expected = brute({v: v & (2**64 - 1) for v in signed}, 2)
    assert {v: roots.get(v, v) for v in signed} == expected


def test_chain_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 500), (7, 6)], "a long, b long")
    assert {r.node: r.root for r in components.components(links).collect()} == {i: 0 for i in range(301)}
    assert components.components(links.filter("false")).collect() == []


def test_odd_rows_and_one_of_each(spark, docs_of, odd_texts):
    docs = docs_of([*odd_texts, *["hot copy of a text that is long enough"] * 100], fp=1, component_id="x")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.col("doc_id")))
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    expected = brute({i: brute_fingerprint(t) for i, t in texts.items()}, 2)
    rows = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == expected and len(rows) == docs.count()
    twice = docs.unionAll(docs.filter("doc_id = 5"))
    kept = simhash.keep_one(twice)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(expected.values()))
    assert kept.filter("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(docs.filter("false")).collect() == []


def test_one_id_with_different_texts(spark, docs_of):
    docs = docs_of(["one text about a mill on a river", "one text about a mill on a river", "another story of ships and the sea", "a third of its own kind entirely"])
    ids = F.element_at(F.array(*map(F.lit, [5, 6, 5, 7])), (F.col("doc_id") + 1).cast("int")).cast("long")
    docs = docs.withColumn("doc_id", ids)
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == [(5, "another story of ships and the sea"), (5, "one text about a mill on a river"), (7, "a third of its own kind entirely")]
    # an id that stands for one group, with a copy of another group's text under it
    more = docs.unionAll(docs.filter("doc_id = 5 AND text LIKE 'one%'").withColumn("doc_id", F.lit(3).cast("long")))
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(more).collect()]
    assert sorted(kept) == [(3, "one text about a mill on a river"), (5, "another story of ships and the sea"), (7, "a third of its own kind entirely")]
