import re
from collections import Counter

from pyspark.sql import functions as F

from tallyworks.llm import quality
from tests.llm.conftest import SF


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def of(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_query_against_plain_python_and_labels(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.op1_quality(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert of(r) == brute(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    judged = [r for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == (labels[r.doc_id] == 1) for r in judged) >= 0.95 * len(judged)


def test_repeats(docs_of):
    texts = ["a b c d e a b c d e", "a a a a a a a", "x y " * 30, "1 2 3 4 5 6 1 2 3 4 5 6 7", "a b c d e", "l\nl\n \nm\nl\n", "q " * 4]
    rows = quality.scored(docs_of(texts, kept="x", n_words=1), ["doc_id", "source"]).collect()
    assert {r.doc_id: of(r) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_odd_rows(docs_of, odd_texts):
    docs = docs_of([*odd_texts, *["one of the sound and plain texts that is kept as it is in any case"] * 30], kept="x", posterior="y", v_lines="z")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.col("doc_id")))
    found = quality.scored(docs, ["doc_id"]).collect()
    assert len(found) == docs.count()
    assert {r.doc_id: of(r) for r in found if r.doc_id is not None and r.doc_id < len(odd_texts)} == {
        i: brute(t) for i, t in enumerate(odd_texts) if i != 3}
    kept = quality.keep_sound(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(len(odd_texts), len(odd_texts) + 30))
    assert quality.scored(docs.filter("false"), ["doc_id"]).collect() == []
    assert quality.keep_sound(docs.filter("false")).collect() == []


def test_no_python_in_the_plan(docs_of):
    plan = quality.scored(docs_of(["a b c"] * 3), ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)
