import itertools
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyworks.llm import langid
from tests.llm.conftest import SF


def test_posteriors_against_all_paths():
    rng = np.random.default_rng(1)
    moves, emit = rng.normal(size=(3, 3)), rng.random((5, 3)) + 0.1
    total = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        weight = np.exp(moves)[:, path[0]].sum() / 3
        for t, s in enumerate(path):
            weight *= emit[t, s] * (math.exp(moves[path[t - 1], s]) if t else 1)
        for t, s in enumerate(path):
            total[t, s] += weight
    assert np.allclose(langid.posteriors(emit, [5], moves), total / total.sum(1, keepdims=True))


def test_pair_posteriors_against_all_paths():
    rng = np.random.default_rng(7)
    moves, sizes = 2 * rng.normal(size=(3, 3)), [4, 1, 6]
    emit, expected, at = rng.random((sum(sizes), 3)) + 0.1, np.zeros((3, 3)), 0
    for size in sizes:
        total, whole = np.zeros((3, 3)), 0.0
        for path in itertools.product(range(3), repeat=size):
            weight = np.exp(moves)[:, path[0]].sum() * math.prod(emit[at + t, s] for t, s in enumerate(path))
            weight *= math.prod(math.exp(moves[a, b]) for a, b in zip(path, path[1:]))
            whole += weight
            for a, b in zip(path, path[1:]):
                total[a, b] += weight
        expected += total / whole
        at += size
    pair = np.array([i for i in range(11) if i not in (0, 4, 5)])
    assert np.allclose(langid.marginals(emit, sizes, moves, pair)[1], expected)


def test_pair_posteriors_over_blocks():
    rng = np.random.default_rng(8)
    moves, n = rng.normal(size=(3, 3)), 200
    emit, step = rng.random((n, 3)) + 0.01, np.exp(moves)
    forward, backward = np.zeros((n, 3)), np.ones((n, 3))
    now = np.full(3, 1 / 3)
    for t in range(n):
        now = (now @ step) * emit[t]
        now /= now.sum()
        forward[t] = now
    for t in range(n - 2, -1, -1):
        backward[t] = step @ (emit[t + 1] * backward[t + 1])
        backward[t] /= backward[t].sum()
    expected = np.zeros((3, 3))
    for t in range(1, n):
        both = forward[t - 1][:, None] * step * (emit[t] * backward[t])[None, :]
        expected += both / both.sum()
    assert np.allclose(langid.marginals(emit, [n], moves, np.arange(1, n))[1], expected)


def test_blocks_do_not_show():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 64, 65, 200, 0, 130, 63]
    moves, emit = rng.normal(size=(4, 4)), rng.random((sum(sizes), 4)) + 0.01
    found, at = langid.posteriors(emit, sizes, moves), 0
    for size in sizes:
        e, step = emit[at : at + size], np.exp(moves)
        forward, backward = np.zeros((size, 4)), np.ones((size, 4))
        now = np.full(4, 0.25)
        for t in range(size):
            now = (now @ step) * e[t]
            now /= now.sum()
            forward[t] = now
        for t in range(size - 2, -1, -1):
            backward[t] = step @ (e[t + 1] * backward[t + 1])
            backward[t] /= backward[t].sum()
        joint = forward * backward
        if size:
            assert np.allclose(found[at : at + size], joint / joint.sum(1, keepdims=True))
        at += size


def test_query_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = langid.op7_language(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    checked = [r for r in rows if r.held_out and truth[r.doc_id].lang]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in checked)
    assert right >= 0.95 * len(checked)


def test_code_switching(docs_of):
    rng = random.Random(3)
    kinds = {"xx": ["kara", "kiro", "kanu", "kelo"], "yy": ["zwim", "zwop", "zwet", "zwun"]}
    texts, langs = [], []
    for i in range(60):
        lang = "xx" if i % 2 else "yy"
        texts.append(" ".join(rng.choice(kinds[lang]) for _ in range(20)))
        langs.append(lang)
    field = langid.fit(texts, langs)
    mixed = docs_of([" ".join(["kara", "kanu"] * 10 + ["zwet", "zwop"] * 4)])
    row = langid.predict(mixed, field, labels=True).first()
    assert row.lang_pred == "xx" and row.word_langs == ["xx"] * 20 + ["yy"] * 8


def test_odd_rows(docs_of, odd_texts):
    docs = docs_of([*odd_texts, "123 !!! 4", "le la"], lang_pred="x", score=3)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.col("lang")))
    field = langid.train(docs, 5)
    rows = {r.doc_id: r for r in langid.predict(docs, field).collect()}
    assert len(rows) == len(odd_texts) + 2
    for i in (0, 1, 2, len(odd_texts)):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[len(odd_texts) + 1].lang_pred == "en"
    nothing = langid.train(docs.filter("false"))
    assert nothing is None and {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.filter("false"), field).collect() == []


def test_rare_languages_are_sampled(docs_of):
    assert langid.quotas({"a": 1000, "b": 3, "c": 40}, 60) == {"b": 3, "c": 28, "a": 29}
    assert sum(langid.quotas({str(i): 5 for i in range(9)}, 4).values()) == 4
    docs = docs_of([f"text {i}" for i in range(4000)])
    rare = F.when(F.col("doc_id") % 1000 == 7, "zz").when(F.col("doc_id") % 2 == 0, "yy").otherwise("xx")
    docs = docs.withColumn("lang", rare)
    rows = langid.training_sample(docs.unionAll(docs.filter("doc_id < 50")), 60).collect()
    found = {lang: sorted(int(r.text.split()[1]) for r in rows if r.lang == lang) for lang in ("xx", "yy", "zz")}
    assert found["zz"] == [7, 1007, 2007, 3007] and len(rows) == len({r.text for r in rows}) == 60
    assert abs(len(found["xx"]) - len(found["yy"])) <= 2


def test_only_letters_are_letters(spark):
    """Fractions, circled numbers and Roman numeral signs are word characters, but no letters."""
    field = langid.fit(["the house is old and the men are here"] * 3 + ["das Haus ist alt und die Leute sind da"] * 3, ["en"] * 3 + ["de"] * 3)
    texts = ["½ ²", "①②③", "Ⅷ ⅻ", "٣٤ 12", "x²", "das ½ Haus"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [r.lang_pred for r in langid.predict(docs, field).orderBy("doc_id").collect()]
    assert found[:4] == ["und"] * 4 and "und" not in found[4:] and found[5] == "de"
    assert langid.letters("a½b²_1Ⅷé") == "abé"
