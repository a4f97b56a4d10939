import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts; the clashing extra columns carry the operators' own names."""

    def make(texts, **extra):
        rows = [(i, t, "en", "src0", len(t) if t else 0) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOC)
        return df.select("*", *[F.lit(v).alias(k) for k, v in extra.items()])

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, repeats, marks, control characters, and a very long text."""
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "Ähre", "über", "naïve", "日本語", "x" * 300, "a.b", "it's", "<|endoftext|>", "3.14", "—", "ﬁ"]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    return [None, "", " \t\n", "one", "two words", "a  b   c ", "  lead", "tail  ", "x\x1cy\x85z w", "▁mark ▁ here",
            "line\nline\n\nline", "é ́x", "😀 \U0001f468‍\U0001f469", long, "same text here", "same text here", "\x00nul \r\n end",
            "<s> </s> <0x41>", "ΣΑΣ ΟΔΟΣ", "İstanbul ǅ"]
