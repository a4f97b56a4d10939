import hashlib
import random
import struct

import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tallyworks.llm import pieces
from tests.llm.conftest import SF


def reference():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.piece_model())


def ints(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_query_against_the_library(spark):
    sp = reference()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pieces.op10_pieces(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = sp.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_odd_texts_ids_spans_and_text(docs_of, odd_texts):
    sp = reference()
    rows = pieces.encode_texts(docs_of(odd_texts, ids=1, n_tokens="x"), pieces.piece_model(), keep=True).collect()
    for r in rows:
        text = odd_texts[r.doc_id] or ""
        assert r.ids == sp.encode(text, add_bos=True, add_eos=True)
        assert r.decoded == sp.decode(r.ids)
        spans = list(zip(r.spans[::2], r.spans[1::2]))
        assert len(spans) == len(r.ids) - 2
        data = text.encode()
        assert [a for a, _ in spans] == [0, *[b for _, b in spans]][: len(spans)]
        assert (spans[-1][1] if spans else 0) == len(data)
        for i, (a, b) in zip(r.ids[1:-1], spans[0 if "▁" not in text else len(spans) :]):
            surface = sp.id_to_piece(i).replace("▁", " ").encode() if not sp.is_byte(i) else data[a:b]
            assert data[a:b] == surface or (a == 0 and surface == b" " + data[a:b])


def test_random_texts_both_paths():
    sp, model, rng = reference(), pieces.PieceModel(pieces.piece_model()), random.Random(3)
    general = pieces.PieceModel(pieces.piece_model())
    general.by_word = False
    for _ in range(300):
        text = "".join(rng.choice("ab  \n\t.▁é日1<>😀the ") for _ in range(rng.randint(0, 60)))
        for own in (model, general):
            ids, spans = own.encode(text)
            assert ints(ids) == sp.encode(text), repr(text)
            assert own.decode(ids) == sp.decode(ints(ids))
        assert (model.encode(text)[1] == general.encode(text)[1]).all(), repr(text)


def double_array(entries):
    """A compiled character map of one-byte keys and of two-byte keys over them, for the test."""
    texts, units = b"", [0] * 4096

    def unit(label, offset, leaf):
        return label | (offset << 10) | (0x100 if leaf else 0)

    units[0] = unit(0, 256, False)
    base, free = 256, 512
    for first in {k[0] for k in entries}:
        at, node = base ^ first, free
        free += 256
        units[at] = unit(first, at ^ node, bytes([first]) in entries)
        if bytes([first]) in entries:
            units[node] = 0x80000000 | len(texts)
            texts += entries[bytes([first])] + b"\0"
        for key in [k for k in entries if len(k) == 2 and k[0] == first]:
            leaf = node ^ key[1]
            end = 3000 + len(texts)
            units[leaf] = unit(key[1], leaf ^ end, True)
            units[end] = 0x80000000 | len(texts)
            texts += entries[key] + b"\0"
    blob = struct.pack("<4096I", *units)
    return struct.pack("<I", len(blob)) + blob + texts


def test_longest_prefix_of_the_character_map_and_alignment():
    proto = pb.ModelProto()
    with open(pieces.piece_model(), "rb") as file:
        proto.ParseFromString(file.read())
    proto.normalizer_spec.precompiled_charsmap = double_array({b"A": b"a", "é".encode(): b"ee", b"\t": b" "})
    own = pieces.PieceModel(proto=proto)
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    assert own.normalise("Aé\tb") == ("▁aee▁b", [0, 0, 0, 0, 1, 1, 3, 3, 3, 4, 5])
    for text in ["Aé\tb", "", "A", "the Aéé the\tA", "xyz"]:
        ids, spans = own.encode(text)
        assert ints(ids) == sp.encode(text)
        assert (spans[-1][1] if len(spans) else 0) == len(text.encode())
        assert own.decode(ids) == sp.decode(ints(ids))


def test_empty_table(docs_of):
    assert pieces.encode_texts(docs_of([]), pieces.piece_model(), keep=True).collect() == []
