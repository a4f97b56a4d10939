import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer

from tallyworks.llm import packing
from tests.llm.conftest import SF


def whole(text):
    encoder = Tokenizer.from_file(packing.word_tokenizer())
    return [*encoder.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, capacity):
    ids = {i: whole(t) for i, t in texts.items()}
    bins = {}
    seen = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.start == r.piece * capacity
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r.ids_crc32
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {i: len(x) for i, x in ids.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(seen.values()) // capacity)


def test_query_against_whole_text_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    used, least = check(packing.op3_packing(spark, SF).collect(), {r.doc_id: r.text for r in docs}, 2048)
    assert used <= least + 1


def test_odd_texts_small_sequences(docs_of, odd_texts):
    docs = docs_of(odd_texts, sequence_id=7, piece="x", ids=1)
    rows = packing.pack_documents(docs, packing.word_tokenizer(), 64).collect()
    used, least = check(rows, dict(enumerate(odd_texts)), 64)
    assert used <= least + 2


def test_groups_and_second_pass(spark):
    rng = random.Random(1)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length long")
    rows = packing.pack_pieces(pieces, 100, group=300).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert sorted(r.doc_id for r in rows) == list(range(3000)) and max(fill.values()) <= 100
    assert len(fill) <= len(packing.best_fit(sizes, 100)) + 2 * 12


def test_exchanges_beat_best_fit():
    # best fit leaves four bins; exchanges reach the three that the total allows
    sizes = [6, 6, 5, 5, 4, 2, 2]
    assert sum(sizes) == 30 and len(packing.pack(sizes, 10)) == 3
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 40))]
        bins = packing.pack(sizes, 50)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
        assert len(bins) <= len(packing.best_fit(sizes, 50))


@pytest.mark.parametrize("texts", [[], [None]])
def test_empty(docs_of, texts):
    rows = packing.pack_documents(docs_of(texts), packing.word_tokenizer()).collect()
    assert [(r.length, r.offset) for r in rows] == [(1, 0)] * len(texts)


def ids_of(texts):
    encoder = Tokenizer.from_file(packing.word_tokenizer())
    found = [encoder.encode(text, add_special_tokens=False).ids for text in texts]
    return [struct.pack(f"<{len(ids)}I", *ids) for ids in found]


class Counted:
    def __init__(self, encoder):
        self.encoder, self.calls = encoder, 0

    def encode(self, *args, **options):
        self.calls += 1
        return self.encoder.encode(*args, **options)


def test_chunks_of_many_texts_are_encoded_in_one_call():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeé", k=7)) + rng.choice(["", ".", "!!"]) for _ in range(5)) for _ in range(150)]
    ids = packing.ChunkIds(packing.word_tokenizer())
    ids.encoder = Counted(ids.encoder)
    runs = list(packing.token_runs([t.encode() for t in texts], ids))
    assert ids.encoder.calls <= 3  # letters, marks; one call a text before
    assert runs == ids_of(texts)
    assert list(packing.token_runs([t.upper().encode() for t in texts], ids)) == runs and ids.encoder.calls <= 3


def test_long_text_and_bounded_table(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_PARTS", 30)
    monkeypatch.setattr(packing, "AT_HAND", 200)
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgß", k=6)) for _ in range(200)]
    texts = ["", " ", "".join(words), *[" ".join(rng.choices(words, k=n)) for n in (1, 400, 3, 0, 20, 60)], " \n".join(words)]
    ids = packing.ChunkIds(packing.word_tokenizer())
    for run, right in zip(packing.token_runs([t.encode() for t in texts], ids), ids_of(texts), strict=True):
        assert run == right
        assert max(len(ids.newer), len(ids.older)) <= 30 + 200


def test_every_low_character_in_a_chunk():
    texts = [f"{left}{chr(c)}{right}" for c in range(0x250) for left, right in (("Ab", "cD"), ("", "e."), ("Ñ!", ""))]
    texts += ["<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>.", "I'LL don't", "A\u0301. a\u0307 İ"]
    ids = packing.ChunkIds(packing.word_tokenizer())
    assert list(packing.token_runs([t.encode() for t in texts], ids)) == ids_of(texts)
    assert list(packing.token_runs([b"", b""], ids)) == [b"", b""] and list(packing.token_runs([], ids)) == []
