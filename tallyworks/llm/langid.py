"""Language of words and documents by a linear-chain conditional random field.

A word has affix (1 to 3 letters), n-gram (2 and 3 letters, with word bounds) and lexicon (whole word) features, hashed to
a fixed number of weights per language; transitions between the languages of neighbouring words are learned with
them. Forward-backward gives each word its posterior, so that code-switched text is labelled word by
word; a document's language has the largest mean posterior.

The field is fitted in one task on a sample of at most ``sample`` labelled documents (by hash of the id, whole texts, cut
into chains of ``CHAIN`` words); the model that goes to the driver and back has a fixed number of weights
per language. Prediction runs over whole texts: chains are split into blocks, whose 4 x 4-like transfer matrices link
them exactly, so a long text costs no more steps than its blocks.

Edge cases: text that is null or has no letter gets ``und`` and score 0, as does everything if no labelled
document is there; a null id never trains and is not held out; repeated rows get the same result; ties go to the language that sorts
first; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tallyworks.llm.common import table

BUCKETS = 1 << 15
SAMPLE = 1200
CHAIN = 128
BLOCK = 64
CHUNK = 300_000
KEPT_WORDS = 400_000
KEPT_GRAMS = 200_000
ROUNDS = 12
RATE = 0.3
DECAY = 1e-6
NONE = "und"


class Hashed(dict):
    """Bucket of a feature; the features of short strings are kept, whole words are not."""

    def __missing__(self, feature: str) -> int:
        if len(self) >= KEPT_GRAMS:
            self.clear()
        found = self[feature] = zlib.crc32(feature.encode()) % BUCKETS
        return found


GRAMS = Hashed()


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word of letters."""
    bound, n = f"^{word}$", len(word) + 2
    # affixes carry the word's bound, so that they differ from inner n-grams of the same letters
    found = ["p" + word[:1], "p" + word[:2], "p" + word[:3], "s" + word[-1:], "s" + word[-2:], "s" + word[-3:]]
    found += [bound[i : i + 2] for i in range(n - 1)]
    found += [bound[i : i + 3] for i in range(n - 2)]
    return [*map(GRAMS.__getitem__, dict.fromkeys(found)), zlib.crc32(word.encode()) % BUCKETS]


def chain_of(text: str | None) -> list[str]:
    """Lower-case words of a text; what has no letter is left out later."""
    return (text or "").lower().split()


def letters(word: str) -> str:
    """Characters of Unicode's letter categories; neither digits nor fractions, ordinals in circles or Roman numeral signs."""
    return "".join(filter(str.isalpha, word))


@dataclass
class Field:
    """Languages, feature weights (buckets x languages) and transition scores."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def __post_init__(self):
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}  # by word as it stands, -1 without a letter
        self.cores: dict[str, int] = {}  # by its letters
        self.scores = np.zeros((0, len(self.langs)))

    def learn(self, words: set[str]) -> None:
        """Makes the emission factors of all ``words`` known."""
        if len(self.rows) > KEPT_WORDS:
            self.clear()
        new, fresh = [], []
        for w in words.difference(self.rows):
            bare = w if w.isalpha() else letters(w)
            if not bare:
                self.rows[w] = -1
                continue
            if (row := self.cores.get(bare)) is None:
                row = self.cores[bare] = len(self.scores) + len(new)
                new.append(bare)
            fresh.append((w, row))
        self.rows.update(fresh)
        if new:
            each = [features(w) for w in new]
            starts = np.cumsum([0, *map(len, each)])[:-1]
            score = np.add.reduceat(self.weights[np.concatenate(each)].astype(np.float64), starts, axis=0)
            factor = np.exp(np.maximum(score - score.max(1, keepdims=True), -30))
            self.scores = np.concatenate([self.scores, factor])

    def lookup(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        return found[found >= 0]


def posteriors(emit: np.ndarray, sizes: list[int], moves: np.ndarray) -> np.ndarray:
    """Posterior of every language for every word of chains joined one after another (forward-backward)."""
    return marginals(emit, sizes, moves)[0]


def marginals(emit: np.ndarray, sizes: list[int], moves: np.ndarray, pair: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors as above and the sum of the pair posteriors of the words at ``pair`` with those before them."""
    n, langs = emit.shape
    lengths: list[int] = []
    for size in sizes:
        lengths += [BLOCK] * (size // BLOCK) + ([size % BLOCK] if size % BLOCK else [])
    count = np.array(lengths, np.int64)
    blocks = len(count)
    if not blocks:
        return np.zeros_like(emit), np.zeros((langs, langs))
    start = np.concatenate([[0], count.cumsum()[:-1]])
    step = np.exp(moves)
    filled = np.ones((BLOCK, blocks, langs))
    at = np.arange(BLOCK)[:, None] < count[None, :]
    place = (start[None, :] + np.arange(BLOCK)[:, None])[at]
    filled[at] = emit[place]
    # transfer of each block
    through = np.broadcast_to(np.eye(langs), (blocks, langs, langs)).copy()
    for t in range(BLOCK):
        live = at[t]
        if not live.any():
            break
        new = (through[live] @ step) * filled[t, live][:, None, :]
        through[live] = new / new.sum((1, 2), keepdims=True)
    # what enters each block from the left and from the right, chain by chain in step
    per = np.array([-(-s // BLOCK) for s in sizes if s], np.int64)
    first = np.concatenate([[0], per.cumsum()[:-1]])
    left, right = np.full((blocks, langs), 1.0 / langs), np.ones((blocks, langs))
    for k in range(1, int(per.max())):
        b = first[per > k] + k
        new = np.einsum("bi,bij->bj", left[b - 1], through[b - 1])
        left[b] = new / new.sum(1, keepdims=True)
    for k in range(1, int(per.max())):
        chosen = per > k
        b = first[chosen] + per[chosen] - 1 - k
        new = np.einsum("bij,bj->bi", through[b + 1], right[b + 1])
        right[b] = new / new.sum(1, keepdims=True)
    forward = np.empty_like(filled)
    now = left
    for t in range(BLOCK):
        new = (now @ step) * filled[t]
        new /= new.sum(1, keepdims=True)
        now = np.where(at[t][:, None], new, now)
        forward[t] = now
    back, out = right, np.empty_like(emit)
    joint = np.empty_like(filled)
    rest = np.empty_like(filled) if pair is not None else None  # the word's own factor and what follows it
    for t in range(BLOCK - 1, -1, -1):
        joint[t] = forward[t] * back
        if rest is not None:
            rest[t] = filled[t] * back
        new = (filled[t] * back) @ step.T
        new /= new.sum(1, keepdims=True)
        back = np.where(at[t][:, None], new, back)
    out[place] = joint[at]
    pairs = np.zeros((langs, langs))
    if pair is not None and len(pair):
        before, after = np.empty_like(emit), np.empty_like(emit)
        before[place], after[place] = forward[at], rest[at]
        before, after = before[pair - 1], after[pair]
        pairs = step * ((before / ((before @ step) * after).sum(1, keepdims=True)).T @ after)
    return out / out.sum(1, keepdims=True), pairs


def fit(texts: list[str], labels: list[str]) -> Field | None:
    """Maximum conditional likelihood by gradient steps (Adagrad) with weight decay."""
    langs = sorted(set(labels))
    ids: dict[str, int] = {}
    words, sizes, truth = [], [], []
    for text, label in zip(texts, labels):
        found = [ids.setdefault(w, len(ids)) for w in map(letters, chain_of(text)) if w]
        words += found
        truth += [langs.index(label)] * len(found)
        sizes += [len(found[k : k + CHAIN]) for k in range(0, len(found), CHAIN)]
    if not words:
        return None
    words, truth = np.array(words), np.array(truth)
    feats = [features(w) for w in ids]
    feature = np.concatenate([np.array(f, np.int64) for f in feats])
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    k = len(langs)
    weights, moves = np.zeros((BUCKETS, k)), np.zeros((k, k))
    seen_w, seen_m = np.full((BUCKETS, k), 1e-8), np.full((k, k), 1e-8)
    starts = np.zeros(len(words), bool)
    starts[np.cumsum([0, *sizes])[:-1]] = True
    pair = np.flatnonzero(~starts)
    counts = np.zeros((k, k))
    np.add.at(counts, (truth[pair - 1], truth[pair]), 1)
    for _ in range(ROUNDS):
        score = np.stack([np.bincount(owner, weights[feature, j], len(feats)) for j in range(k)], 1)
        emit = np.exp(np.maximum(score - score.max(1, keepdims=True), -30))[words]
        post, expected = marginals(emit, sizes, moves, pair)
        miss = -post
        miss[np.arange(len(words)), truth] += 1
        by_word = np.stack([np.bincount(words, miss[:, j], len(feats)) for j in range(k)], 1)
        slope = np.stack([np.bincount(feature, by_word[owner, j], BUCKETS) for j in range(k)], 1) / len(words) - DECAY * weights
        turn = (counts - expected) / max(1, len(pair)) - 1e-3 * moves
        seen_w += slope**2
        seen_m += turn**2
        weights += RATE * slope / np.sqrt(seen_w)
        moves += RATE * turn / np.sqrt(seen_m)
    return Field(langs, weights.astype(np.float32), moves)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quotas(counts: dict[str, int], sample: int) -> dict[str, int]:
    """How many documents of each language make up ``sample``: the same of each as far as it has them."""
    found, left = {}, sample
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        found[lang] = min(n, left // (len(counts) - k))
        left -= found[lang]
    return found


def training_sample(docs: DataFrame, sample: int) -> DataFrame:
    """text and lang of at most ``sample`` different documents with text and language, dealt evenly to the languages: of each
    the first by hash of the id."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    # one row per language; a little more than the estimate, so that no document of a rare language is left out
    counts = {r.lang: int(1.1 * r.n) + 1 for r in known.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).collect()}
    dealt = quotas(counts, sample)
    # over twice each quota by hash, so that what goes to the one task does not grow with the table or its partitions
    below = [(lang, int(min(1.0, (2 * n + 20) / counts[lang] * 1.2) * (1 << 40)) + 1) for lang, n in dealt.items() if n]
    limits = docs.sparkSession.createDataFrame(below, "_lang string, _below long")
    near = known.select("doc_id", "text", "lang").join(F.broadcast(limits), F.col("lang") == F.col("_lang")).filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.col("_below"))
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")]
    ranked = near.dropDuplicates(["doc_id", "text", "lang"]).withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.orderBy("_rank", *order, "lang").limit(sample).select("text", "lang")


def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field from at most ``sample`` documents with text and language; other columns are not looked at."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "lang": []}), *frames])
        field = fit(rows["text"].tolist(), rows["lang"].tolist())
        if field:
            yield pd.DataFrame({"langs": [field.langs], "weights": [field.weights.tobytes()], "moves": [field.moves.tobytes()]})

    rows = training_sample(docs, sample).coalesce(1).mapInPandas(run, "langs array<string>, weights binary, moves binary").collect()
    if not rows:
        return None
    langs = list(rows[0].langs)
    return Field(langs, np.frombuffer(rows[0].weights, np.float32).reshape(BUCKETS, len(langs)),
                 np.frombuffer(rows[0].moves, np.float64).reshape(len(langs), len(langs)))


def chunks(texts: Iterator[str | None], field: Field) -> Iterator[list[np.ndarray]]:
    """Rows of emission factors of each text, in groups of bounded word count."""
    held: list[list[str]] = []
    n = 0

    def rows() -> list[np.ndarray]:
        field.learn(set().union(*held))
        return [field.lookup(words) for words in held]

    for text in texts:
        words = chain_of(text)
        if held and n + len(words) > CHUNK:
            yield rows()
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield rows()


def predict(docs: DataFrame, field: Field | None, labels: bool = False) -> DataFrame:
    """doc_id, lang_pred and score (mean posterior); ``labels`` adds word_langs, the language of each word with letters."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spec = "lang_pred string, score double" + (", word_langs array<string>" if labels else "")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *_parse_datatype_string(spec).fields])
    out = to_arrow_schema(schema)
    given = (field.langs, field.weights.tobytes(), field.moves) if field else None
    shared = docs.sparkSession.sparkContext.broadcast(given)  # BUCKETS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value:
            langs, weights, moves = shared.value
            own = Field(langs, np.frombuffer(weights, np.float32).reshape(BUCKETS, len(langs)), moves)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not shared.value:
                result = [(NONE, 0.0, [])] * len(texts)
            else:
                result = []
                for rows in chunks(iter(texts), own):
                    post = posteriors(own.scores[np.concatenate(rows)], [len(r) for r in rows], own.moves)
                    at = 0
                    for r in rows:
                        part = post[at : at + len(r)]
                        at += len(r)
                        if len(r):
                            mean = part.mean(0)
                            best = int(mean.argmax())
                            tags = [own.langs[j] for j in part.argmax(1)] if labels else None
                            result.append((own.langs[best], min(1.0, float(mean[best])), tags))
                        else:
                            result.append((NONE, 0.0, []))
            columns = list(zip(*result)) if result else [()] * 3
            arrays = [pa.array(list(c), out.field(i + 1).type) for i, c in enumerate(columns[: len(out) - 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    field = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, field).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
