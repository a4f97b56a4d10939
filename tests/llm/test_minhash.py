import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import minhash
from tests.llm.conftest import SF


def jaccard(a, b, n=5):
    def shingles(text):
        w = text.encode().split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def plain(rows):
    """The digests and exact similarities of documents in descending order of id."""
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        m = len(text) // 3
        changed = text[: len(text) - m] + following[:m]
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), jaccard(text, changed), jaccard(text, following))
    return out


def single(texts, shape=minhash.Shape()):
    values, some = minhash.bin_values([t.encode() for t in texts], shape, minhash.WordHashes())
    return minhash.packed(values, some, shape.bits)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = plain(sorted(((r.doc_id, r.text or "") for r in docs), reverse=True))
    found = minhash.op11_fingerprints(spark, SF).collect()
    assert len(found) == len(docs)
    errors = []
    for r in found:
        n, digest, near_edited, near_next = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        errors += [r.near_edited - near_edited, r.near_next - near_next]
        assert r.near_edited == minhash.likeness(bytes.fromhex(r.fingerprint), bytes.fromhex(r.edited_fingerprint))
    assert max(map(abs, errors)) < 0.17 and abs(np.mean(errors)) < 0.01  # standard error at most 0.034
    texts, prints = {}, {r.doc_id: r.fingerprint for r in found}
    for r in docs:
        assert texts.setdefault(r.text, prints[r.doc_id]) == prints[r.doc_id]


@pytest.mark.parametrize("bins,bits", [(64, 2), (256, 4), (512, 8)])
def test_no_bias(bins, bits):
    """The mean estimate over many pairs of small and large sets meets their similarity."""
    rng = random.Random(bins)
    shape = minhash.Shape(bins, bits)
    for words, share in ((16, 0.8), (40, 0.7), (3000, 0.8)):  # far enough from 0, where estimates are cut off
        errors = []
        for _ in range(150):
            a = [f"{rng.random():.12f}" for _ in range(words)]
            b = a[: int(words * share)] + [f"{rng.random():.12f}" for _ in range(words - int(words * share))]
            x, y = single([" ".join(a), " ".join(b)], shape)
            errors.append(minhash.likeness(x, y, shape) - jaccard(" ".join(a), " ".join(b)))
        assert abs(np.mean(errors)) < 4 * np.std(errors) / 150**0.5 + 0.01


def test_densification_by_hand():
    """Every empty bin holds what the first occupied bin in its own order holds; minima as a plain loop finds them."""
    shape, known = minhash.Shape(32, 8, 2), minhash.WordHashes()
    values, some = minhash.bin_values([b"a b c d", b"", b"x"], shape, known)
    f = [int(v) for v in minhash.factors(2)]
    w = [known[x] for x in (b"a", b"b", b"c", b"d")]
    hashes = minhash.mixed(np.array([(x * f[0] + y * f[1]) % 2**64 for x, y in zip(w, w[1:])], np.uint64)).tolist()
    bins = {}
    for h in hashes:
        bins[h >> 59] = min(bins.get(h >> 59, 2**64), h & (2**59 - 1))
    order = minhash.probes(32).tolist()
    least = [bins[next(b for b in ([i] if i in bins else order[i]) if b in bins)] for i in range(32)]
    salted = np.array([(v + (i + 1) * 0x9E3779B97F4A7C15) % 2**64 for i, v in enumerate(least)], np.uint64)
    assert values[0].tolist() == [x & 255 for x in minhash.mixed(salted).tolist()] and some.tolist() == [True, False, True]
    # texts of one shingle fill all bins with one value each, and still agree by chance in few
    x, y = single(["first", "second"])
    assert minhash.likeness(x, y) < 0.1


def test_over_ranges(spark, docs_of, odd_texts):
    """Odd texts over many ranges, repeated rows, a null id and clashing columns."""
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(3, odd_texts[3]), (None, "last of all"), (7, "other text of an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit(1)).withColumn("edge", F.lit("x")).withColumn("n_chars", F.lit("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = minhash.edited(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows)
    unique = {i: t or "" for i, t in rows if i not in (3, 7)}
    expected = plain(sorted(((-1 if i is None else i, t or "") for i, t in rows), reverse=True))
    following = {8: None, 4: None, 3: None, 7: None}  # what follows these depends on ties
    for r in found:
        key = -1 if r.doc_id is None else r.doc_id
        if r.doc_id in unique and key not in following:
            assert (r.n_chars, r.edited_sha256) == expected[key][:2]
            if max(expected[key][2:]) in (0, 1):
                assert (r.near_edited, r.near_next) == pytest.approx(expected[key][2:], abs=0.06)
    assert {r.n_chars for r in found if r.doc_id == 7} == {len(unique_text) for unique_text in (odd_texts[7], "other text of an id")}
    assert len({r.fingerprint for r in found if r.doc_id == 3}) == 1
    empties = [r for r in found if r.doc_id in (0, 1, 2)]
    assert all(r.fingerprint == "" for r in empties)


def test_small_tables(spark):
    df = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    (only,) = minhash.edited(df).collect()
    assert only.near_next == 1.0
    assert only.edited_sha256 == hashlib.sha256(("one two three"[:9] + "one ").encode()).hexdigest()
    assert minhash.edited(df.filter("false")).collect() == []
    assert minhash.with_fingerprints(df.filter("false")).collect() == []


def test_with_fingerprints(spark, odd_texts):
    rows = [(i, t, "old") for i, t in enumerate(odd_texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, Fingerprint string")
    found = minhash.with_fingerprints(df)
    assert found.columns == ["doc_id", "text", "fingerprint"]
    expected = [x.hex() for x in single([t or "" for t in odd_texts])]
    assert [(r.doc_id, r.text, r.fingerprint) for r in found.orderBy("doc_id").collect()] == [(i, t, f) for (i, t, _), f in zip(rows, expected)]
