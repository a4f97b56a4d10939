"""SentencePiece (BPE) encoding with offsets, and decoding.

Normalisation replaces, at each place, the longest prefix that the model's compiled character map
knows, and records which source byte each normalised byte came from. Pieces found in the normalised text are
projected through that record to byte spans of the original text.

Where the character map is empty and no piece has a space mark after another character, text falls apart at
spaces: the ids of a word with its leading space do not depend on its neighbours, so a bounded
table per worker keeps them. Other models take the general path over the whole text.

Edge cases: null text counts as empty; empty text has the begin and end id only and decodes to empty text;
repeated rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import table

MARK = "▁"
#: Words (and parts of words) whose ids a worker keeps at least, and twice as many at most.
KEPT_WORDS = 250_000
#: Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharMap:
    """The compiled character map: a double array of prefixes and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size :] if blob else b""

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix at ``start`` and its replacement."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        pos = (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(start, len(data)):
            pos ^= data[k]
            if pos >= len(units):
                break
            unit = units[pos]
            if unit & 0x800000FF != data[k]:
                break
            pos ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100 and pos < len(units):
                at = units[pos] & 0x7FFFFFFF
                found = k + 1 - start, self.texts[at : self.texts.index(b"\0", at)]
        return found


class PieceModel:
    """A BPE model: normalising, encoding with spans, decoding."""

    def __init__(self, path: str | None = None, proto=None):
        from sentencepiece import sentencepiece_model_pb2 as pb

        if proto is None:
            proto = pb.ModelProto()
            with open(path, "rb") as file:
                proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        self.charmap = CharMap(norm.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.pieces = [p.piece for p in proto.pieces]
        self.kind = [p.type for p in proto.pieces]
        self.ids = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
        if any(t in (USER_DEFINED, UNUSED) for t in self.kind):
            raise ValueError("models with user-defined or unused pieces are not covered")
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.kind)) if t == BYTE}
        self.unk = self.kind.index(UNKNOWN)
        self.bos, self.eos = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.surface = [
            bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.encode()
            for p, t in zip(self.pieces, self.kind)
        ]
        self.by_word = (
            not self.charmap.units and self.escape and self.dummy and not self.squeeze
            and not any(MARK in p.lstrip(MARK) for p in self.ids)
        )
        #: neighbours inside pieces: text can be cut between any other two characters
        self.beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: bytes of the source that a piece covers where the only change is a mark for each space
        self.covers = np.array([0 if t == CONTROL else 1 if t == BYTE else len(p.encode()) - 2 * p.count(MARK)
                                for p, t in zip(self.pieces, self.kind)], np.int64)
        # ids by word with its leading space, and by part of a word, in two generations
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """Normalised text, and for each of its bytes and its end the source byte it came from."""
        data = text.encode()
        parts: list[tuple[bytes, int, int]] = []  # replacement, source start, source end
        at = 0
        while at < len(data):
            hit = self.charmap.longest(data, at)
            if hit:
                size, new = hit
            else:
                size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                new = data[at : at + size]
            parts.append((new, at, at + size))
            at += size
        if self.squeeze:
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
            while parts and parts[-1][0] in (b" ", b""):
                parts.pop()
        out, source, space = bytearray(), [], MARK.encode() if self.escape else b" "

        def put(new: bytes, start: int) -> None:
            out.extend(new)
            source.extend([start] * len(new))

        if parts and self.dummy:
            put(space, parts[0][1])
        was_space = False
        for new, start, _ in parts:
            for piece in re.findall(b" |[^ ]+", new):
                if piece == b" ":
                    if not (self.squeeze and was_space):
                        put(space, start)
                else:
                    put(piece, start)
                was_space = piece == b" "
        return out.decode(), [*source, parts[-1][2] if parts else 0]

    def split(self, text: str) -> list[str]:
        """Pieces of normalised text: the best-scored pair is merged first, the leftmost among equals."""
        parts = list(text)
        if len(parts) > 64:
            return self.split_long(parts)
        ids, none = self.ids, -math.inf
        scores = [hit[1] if (hit := ids.get(a + b)) else none for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) != none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = hit[1] if (hit := ids.get(parts[i - 1] + parts[i])) else none
            if i < len(scores):
                scores[i] = hit[1] if (hit := ids.get(parts[i] + parts[i + 1])) else none
        return parts

    def split_long(self, parts: list[str]) -> list[str]:
        """The same with a heap, for text in one long part."""
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (hit := self.ids.get(both := parts[a] + parts[b])):
                heapq.heappush(heap, (-hit[1], a, b, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if parts[a] + parts[b] != both or right[a] != b or not parts[b]:
                continue
            parts[a], parts[b], right[a] = both, "", right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p]

    def numbered(self, parts: list[str]) -> list[int]:
        """Ids of pieces; what is no piece becomes bytes, or one unknown id for each run."""
        found: list[int] = []
        for p in parts:
            if hit := self.ids.get(p):
                found.append(hit[0])
            elif self.bytes:
                found += [self.bytes[x] for x in p.encode()]
            elif not found or found[-1] != self.unk:
                found.append(self.unk)
        return found

    def part(self, text: str) -> bytes:
        """Ids of a part of normalised text that no piece crosses the ends of."""
        if (ids := self.parts.get(text)) is None:
            if (ids := self.older_parts.get(text)) is None:
                found = self.numbered(self.split(text))
                ids = struct.pack(f"<{len(found)}I", *found)
            if len(text) <= 64:
                self.parts[text] = ids
        return ids

    def word(self, word: str) -> bytes:
        """Ids of a word after a space (or after the added mark)."""
        text = MARK + word.replace(" ", MARK)
        cuts = [0, *[i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.beside], len(text)]
        # single characters that nothing joins are cheap; longer parts are kept
        return b"".join([self.part(text[a:b]) for a, b in zip(cuts, cuts[1:])])

    def learn(self, words: set[str]) -> None:
        """Makes the ids of all ``words`` known."""
        if len(self.words) >= KEPT_WORDS:
            self.older, self.words = self.words, {}
        if len(self.parts) >= KEPT_WORDS:
            self.older_parts, self.parts = self.parts, {}
        for word in words.difference(self.words):
            ids = self.older.get(word)
            self.words[word] = self.word(word) if ids is None else ids

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids (little-endian 32 bit) and the source byte span of each piece, shape (n, 2)."""
        if not text:
            return b"", np.zeros((0, 2), np.int64)
        if self.by_word and MARK not in text:
            if "  " in text or text[0] == " ":
                # each run of spaces goes with the word after it
                found = re.findall(" *[^ ]+| +", text)
                groups = [found[0], *[w[1:] for w in found[1:]]]
            else:
                groups = text.split(" ")
            self.learn(set(groups))
            ids = b"".join(map(self.words.__getitem__, groups))
            sizes = self.covers[np.frombuffer(ids, "<u4")]
            sizes[0] -= 1  # the added mark covers nothing
            ends = sizes.cumsum()
            return ids, np.stack([ends - sizes, ends], 1)
        normal, source = self.normalise(text)
        ids, spans, at = [], [], 0
        for p in self.split(normal):
            own = self.numbered([p])
            if own == [self.unk] == ids[-1:]:
                spans[-1][1] += len(p.encode())
            else:
                step = len(p.encode()) // len(own)
                ids += own
                spans += [[at + k * step, at + (k + 1) * step] for k in range(len(own))]
            at += len(p.encode())
        return struct.pack(f"<{len(ids)}I", *ids), np.array(source, np.int64)[np.array(spans, np.int64).reshape(-1, 2)]

    def decode(self, ids: bytes) -> str:
        """Text of ids; the mark that opens the first piece is the added prefix and goes."""
        data = b"".join(map(self.surface.__getitem__, memoryview(ids).cast("I")))
        data = data.removeprefix(MARK.encode()) if self.dummy or self.squeeze else data
        return data.decode("utf-8", "replace").replace(MARK, " ")


@lru_cache(2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode_texts(docs: DataFrame, model: str, keep: bool = False) -> DataFrame:
    """Ids with begin and end, spans and decoded text of every document, and their digests.

    ``keep`` returns ``ids`` and ``spans`` (int arrays; spans as start, end, start, ...) and ``decoded`` as well.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    kept = ", ids array<int>, spans array<int>, decoded string" if keep else ""
    digests = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long" + kept
    schema = StructType([docs.schema["doc_id"], *_parse_datatype_string(digests).fields])
    out = to_arrow_schema(StructType([StructField(f.name, f.dataType) for f in schema.fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        begin, end = (struct.pack("<I", i) for i in (pieces.bos, pieces.eos))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                ids, spans = pieces.encode(text or "")
                ids = begin + ids + end
                decoded = pieces.decode(ids)
                row = (doc.as_py(), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
                       zlib.crc32(spans.astype("<u4").tobytes()))
                rows.append((*row, array("I", ids).tolist(), spans.ravel().tolist(), decoded) if keep else row)
            columns = list(zip(*rows)) if rows else [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with begin and end ids and decoded again."""
    return encode_texts(table(spark, sf_dir, "documents"), piece_model())
