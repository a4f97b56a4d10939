"""Best-fit packing of token runs into fixed-length sequences, improved by swap-based local search.

Text becomes ids chunk by chunk: white space is dropped by the tokenizer and no token crosses it, so the ids
of a chunk between ASCII white space never depend on its neighbours. A worker takes some megabytes of text at a time, looks up
each different chunk of them once, and keeps the ids in a bounded table.
Pieces are then dealt at random into groups of bounded size. A group is packed by
best fit, longest first; then the least filled bin gives its pieces away by moves, one-for-one and
two-for-one exchanges, each of which raises the sum of squared fills, until it is empty or none is left.
The pieces of each group's underfull bins are dealt and packed once more, so that the loss is one bin per
group of the second pass only.

Edge cases: null and empty text give the end id alone; repeated rows are separate documents; a null document id
is kept; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import quoted, table, written

#: Parts whose ids a worker keeps at least, and twice as many and those at hand at most.
KEPT_PARTS = 500_000
#: Bytes of text that a worker encodes at a time, about.
AT_HAND = 1 << 22
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,;:!?*&%$#\"()]"
#: Latin-1 letters, then marks that the tokenizer parts from them.
PLAIN = f"^(?P<letters>{LETTERS})(?P<marks>{MARKS}*)$"
#: What is one pre-token.
PART = re.compile(f"{LETTERS}|{MARKS}+")
NOTHING = pa.scalar(b"", pa.large_binary())
GAP_BYTE = re.compile(rb"[\x20\x09-\x0D]")
#: Pieces of one packing group, about.
GROUP = 4096
PIECES = "piece int, start long, length long, ids_crc32 long, ids binary"


class ChunkIds:
    """Little-endian 32-bit ids of chunks.

    A chunk of Latin letters and closing marks has the ids of its lower-case letters, then those of the marks, because the
    tokenizer parts them; so letters are encoded once for all cases and marks. Letters, marks and other whole chunks are
    the parts that are kept, in two generations: when the newer is full, the older goes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of_texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. Equal chunks of all the texts are looked up once."""
        chunks = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = chunks.values.dictionary_encode()
        runs = self.of_chunks(coded.dictionary).take(coded.indices)
        if not len(runs):
            return [b""] * len(texts)
        _, ends, data = runs.buffers()  # the ids of all chunks, one after another
        at = np.frombuffer(ends, "<i8", len(runs) + 1)[chunks.offsets.to_numpy()].tolist()
        return [data[start:end].to_pybytes() for start, end in zip(at, at[1:])]

    def of_chunks(self, chunks: pa.StringArray) -> pa.LargeBinaryArray:
        plain = pc.extract_regex(chunks, PLAIN)
        letters = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "letters")), chunks)
        marks = pc.fill_null(pc.struct_field(plain, "marks"), "")
        return pc.binary_join_element_wise(self.of_parts(letters), self.of_parts(marks), NOTHING)

    def of_parts(self, parts: pa.StringArray) -> pa.LargeBinaryArray:
        coded = parts.dictionary_encode()
        parts = coded.dictionary.to_pylist()
        found = list(map(self.newer.get, parts))
        if missing := [part for part, ids in zip(parts, found) if ids is None]:
            self.learn(missing)
            newer = self.newer
            found = [newer[part] if ids is None else ids for part, ids in zip(parts, found)]
        return pa.array(found, pa.large_binary()).take(coded.indices)

    def learn(self, missing: list[str]) -> None:
        """Puts the ids of parts that are not in the newer table there."""
        if len(self.newer) >= KEPT_PARTS:
            self.older, self.newer = self.newer, {}
        newer, older = self.newer, self.older
        new = []
        for part in missing:
            if (ids := older.get(part)) is not None:
                newer[part] = ids
            elif PART.fullmatch(part):
                new.append(part)
            else:
                newer[part] = np.array(self.encoder.encode(part, add_special_tokens=False).ids, "<u4").tobytes()
        for k in range(0, len(new), 1000):  # one call for many; the pre-token numbers tell their ids
            some = new[k : k + 1000]
            found = self.encoder.encode(" ".join(some), add_special_tokens=False)
            run = np.array(found.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(found.word_ids, np.arange(len(some)), "right")).tolist()
            for part, start, end in zip(some, [0, *ends], ends):
                newer[part] = run[start:end]


@lru_cache(2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def cut_at_gaps(data: bytes) -> Iterator[bytes]:
    at = 0
    while gap := GAP_BYTE.search(data, at + AT_HAND):
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:]


def token_runs(texts: Iterable[bytes], ids: ChunkIds) -> Iterator[bytes]:
    """The ids of each text; short texts are taken together, long ones chunk after chunk."""
    group, size = [], 0
    for data in texts:
        if group and size + len(data) > AT_HAND:
            yield from ids.of_texts(group)
            group, size = [], 0
        if len(data) > AT_HAND:
            yield b"".join(ids.of_texts([part])[0] for part in cut_at_gaps(data))
        else:
            group.append(data)
            size += len(data)
    if group:
        yield from ids.of_texts(group)


def token_pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most ``length``."""
    id_type = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, step = chunk_ids(tokenizer), end_id.to_bytes(4, "little"), 4 * length
        for batch in batches:
            rows = []
            texts = (data or b"" for data in batch.column(1).to_pylist())
            for doc, run in zip(batch.column(0), token_runs(texts, ids)):
                run, doc = run + end, doc.as_py()
                for k in range(0, len(run), step):
                    part = run[k : k + step]
                    rows.append((doc, k // step, k // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    schema = StructType([StructField("doc_id", id_type), *_parse_datatype_string(PIECES).fields])
    out = to_arrow_schema(schema)
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(cut, schema)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``sizes``, longest first into the fullest bin that takes it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    rooms = 0  # bit r: a bin with room r
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        if room - size:
            free[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins


def give_away(bins: list[list[int]], victim: int, sizes: list[int], room: list[int], others: list[int]) -> bool:
    """One step that shifts load from the victim to a fuller bin; false if none is left."""
    mine = sorted(bins[victim], key=lambda i: -sizes[i])
    for a in mine:  # move
        if targets := [b for b in others if room[b] >= sizes[a]]:
            return shift(bins, victim, min(targets, key=lambda b: room[b]), [a], [], sizes, room)
    best = None
    for n, gives in enumerate(([(a,) for a in mine], [(a, c) for k, a in enumerate(mine) for c in mine[k + 1 :]])):
        for give in gives:  # one or two for one
            load = sum(sizes[i] for i in give)
            for b in others:
                for i in bins[b]:
                    gain = load - sizes[i]
                    if 0 < gain <= room[b] and (best is None or gain > best[0]):
                        best = gain, b, give, i
        if best:
            return shift(bins, victim, best[1], list(best[2]), [best[3]], sizes, room)
    return False


def shift(bins, a: int, b: int, gives: list[int], takes: list[int], sizes: list[int], room: list[int]) -> bool:
    bins[a] = [i for i in bins[a] if i not in gives] + takes
    bins[b] = [i for i in bins[b] if i not in takes] + gives
    gain = sum(sizes[i] for i in gives) - sum(sizes[i] for i in takes)
    room[a] += gain
    room[b] -= gain
    return True


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit, then the least filled bins are emptied by moves and exchanges while that works."""
    bins = best_fit(sizes, capacity)
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    least = -(-sum(sizes) // capacity)
    live = sorted((b for b in range(len(bins)) if room[b]), key=lambda b: -room[b])
    gone = 0
    while len(bins) - gone > least and len(live) > 1:
        victim = max(live, key=lambda b: room[b])
        others = [b for b in live if b != victim and room[b]]
        while bins[victim] and give_away(bins, victim, sizes, room, others):
            others = [b for b in others if room[b]]
        if bins[victim]:
            break
        gone += 1
        live = others
    return [b for b in bins if b]


def _packed(pieces: DataFrame, capacity: int, level: int, group: int, again: bool) -> DataFrame:
    """Packs groups of about ``group`` pieces; with ``again``, pieces in underfull bins get no sequence."""
    groups = max(1, -(-pieces.count() // group))
    schema = pieces.schema.names
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(groups)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", kind="stable").reset_index(drop=True)
        sizes = frame["length"].astype(int).tolist()
        seq, offset = [None] * len(sizes), [None] * len(sizes)
        base = (level << 60) + (int(frame["_group"].iloc[0]) << 16)
        for k, b in enumerate(pack(sizes, capacity)):
            at = 0
            if again and sum(sizes[i] for i in b) < 0.98 * capacity:
                continue
            for i in b:
                seq[i], offset[i], at = base + k, at, at + sizes[i]
        frame["sequence_id"], frame["offset"] = pd.array(seq, "Int64"), pd.array(offset, "Int64")
        return frame.drop(columns="_group")

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    assert "sequence_id" not in schema
    return dealt.groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_pieces(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``.

    ``pieces`` needs ``length`` (1 to ``capacity``). A group holds about ``group`` pieces (at most 65,536
    bins), whatever the input; more input only makes more groups.
    """
    rows = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    first = written(_packed(rows, capacity, 0, group, True), "packed")
    rest = first.filter("sequence_id IS NULL").drop("sequence_id", "offset")
    second = _packed(rest, capacity, 1, group, False)
    return first.filter("sequence_id IS NOT NULL").unionByName(second).drop("_row")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Documents as pieces in sequences; ``ids`` holds the ids (little-endian 32 bit) if asked for. Packing moves lengths only; the ids
    join their places once, by the piece's number."""
    pieces = token_pieces(docs, tokenizer, capacity, keep_ids=keep_ids)
    if not keep_ids:
        return pack_pieces(pieces.drop("ids"), capacity)
    cut = written(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces-with-ids")
    placed = pack_pieces(cut.drop("ids"), capacity)
    return placed.join(cut.select("_piece", "ids"), "_piece").drop("_piece")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())
