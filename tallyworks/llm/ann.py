"""Approximate nearest neighbours by stable projections and a kd-tree with a chi-square stopping test.

Largest inner product becomes least distance by one added coordinate (root of the largest squared norm less the own).
Vectors are projected to a few dimensions by a Gaussian matrix, so that the squared projected distance of a
pair over its squared true distance follows a chi-square law. Vectors are dealt into blocks of bounded size; each block has a
kd-tree over its projections. A query verifies its projected neighbours with the original coordinates, nearest first and a few at
a time, and stops when a vector as near as its k-th best would, by that law, have been met before with the wished probability: when the
next projected distance is beyond the law's quantile for the k-th best. Leaves of the tree that lie wholly beyond it aren't opened. Large groups
of queries meet blocks of vectors; the best of each block are merged per query.

Edge cases: vectors that are null, empty or zero, or hold null, NaN or infinite components, take no part; vectors of different
lengths never compare; rows whose id is null take no part; repeated ids are candidates of their own, but never of a query of the same
id; repeated queries are searched once, and queries of one id with different vectors share one list, in which a candidate row
has its best score; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import table, written

SEED = 42
DIMS = 32  # projected dimensions
SURE = 0.90  # wished probability of having met a neighbour before stopping
LEAF = 64
BLOCK = 8192  # vectors of a kd-tree
ASKED = 1 << 21  # components of the queries that meet a block at a time: 16 MB
STEP = 64  # projected neighbours that are verified first, before the test; then half as many more each time
CHUNK = 64  # queries whose projected distances are computed together
RESULT = "query_id long, vec_id long, row long, score double"


def chi_square_cdf(x: float, dims: int) -> float:
    """Probability that a chi-square variable with an even number of dimensions is at most ``x``."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(dims // 2))


@lru_cache(8)
def chi_square_cut(dims: int, sure: float) -> float:
    low, high = 0.0, 100.0 * dims
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < sure else (low, mid)
    return high


@lru_cache(8)
def projection(size: int, dims: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dims))


@dataclass
class Tree:
    """Leaves of a balanced kd-tree: their boxes and the order of the points."""

    order: np.ndarray
    cuts: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Halves along the widest side until a leaf holds at most ``leaf`` points; equal points may be parted."""
    parts, leaves = [np.arange(len(points))], []
    while parts:
        part = parts.pop()
        if len(part) <= leaf:
            leaves.append(part)
            continue
        own = points[part]
        axis = int((own.max(0) - own.min(0)).argmax())
        half = len(part) // 2
        part = part[np.argpartition(own[:, axis], half)]
        parts += [part[half:], part[:half]]
    return Tree(
        np.concatenate(leaves), np.cumsum([0, *map(len, leaves)]),
        np.array([points[x].min(0) for x in leaves]), np.array([points[x].max(0) for x in leaves]),
    )


def search(ids: np.ndarray, vectors: np.ndarray, asked_ids: np.ndarray, asked: np.ndarray, top: float, k: int, dims: int, sure: float):
    """(query id, id, score, vectors verified, place in the block) of each query's nearest in one block; ``top`` is the largest squared
    norm of all."""
    size = vectors.shape[1]
    matrix = projection(size + 1, dims)
    extra = np.sqrt(np.maximum(top - (vectors**2).sum(1), 0))
    points = vectors @ matrix[:size] + extra[:, None] * matrix[size]
    tree = build(points)
    ordered, ordered_ids, points = vectors[tree.order], ids[tree.order], points[tree.order]
    lengths = np.diff(tree.cuts)
    squares = (points**2).sum(1)
    cut = chi_square_cut(dims, sure)
    slack = 1e-9 * max(top, 1e-300)
    targets = asked @ matrix[:size]  # a query's added coordinate is zero
    for start in range(0, len(asked), CHUNK):
        some = targets[start : start + CHUNK]
        distances = np.maximum(squares - 2 * (some @ points.T) + (some**2).sum(1)[:, None], 0)
        for q, row in enumerate(distances, start):
            yield one_query(q, row, asked, asked_ids, targets, tree, lengths, ordered, ordered_ids, top, cut, slack, k)


def one_query(q, row, asked, asked_ids, targets, tree, lengths, ordered, ordered_ids, top, cut, slack, k):
    """Verify the projected neighbours of one query, ``row`` away, in order until the test holds."""
    query, query_id = asked[q], asked_ids[q]
    norm = float((query**2).sum())
    mine = ordered_ids != query_id
    # the first few: they give a k-th best, and with it the radius beyond which nothing is looked for
    first = np.argpartition(row, STEP)[:STEP] if len(row) > STEP else np.arange(len(row))
    first = first[mine[first]]
    places, scores = [first], [ordered[first] @ query]
    held, verified = scores[0], len(first)

    def bound() -> float:
        return float(held.min()) if len(held) == k else -math.inf

    def radius() -> float:
        return cut * max(norm + top - 2 * bound(), 0) + slack if len(held) == k else math.inf

    held = np.partition(held, len(held) - k)[len(held) - k :] if len(held) > k else held
    reach = radius()
    gap = np.maximum(np.maximum(tree.low - targets[q], targets[q] - tree.high), 0)
    opened = np.repeat((gap**2).sum(1) <= reach, lengths)
    rest = opened & mine & (row <= reach)
    rest[first] = False
    rest = np.flatnonzero(rest)
    rest = rest[np.argsort(row[rest], kind="stable")]
    done, step = 0, STEP
    while done < len(rest) and row[rest[done]] <= radius():
        at = rest[done : done + step]
        found = ordered[at] @ query
        done, step, verified = done + len(at), step * 3 // 2, verified + len(at)
        near = found >= bound() - slack
        places.append(at[near])
        scores.append(found[near])
        held = np.concatenate([held, found[near]])
        held = np.partition(held, len(held) - k)[len(held) - k :] if len(held) > k else held
    at, found = np.concatenate(places), np.concatenate(scores)
    at = at[found >= bound() - slack]
    exact = (ordered[at] * query).sum(1)  # one way of adding up, so that equal vectors tie
    best = np.lexsort((ordered_ids[at], -exact))[:k]
    return query_id, ordered_ids[at][best], exact[best], verified, tree.order[at[best]]


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, dims: int = DIMS, sure: float = SURE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (largest inner products) of every id of ``queries`` among the rows of ``vectors``.

    Both need vec_id and embedding. A task holds one block of vectors and queries of about ``ASKED`` components.
    """
    narrow = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")]

    def ready(df: DataFrame) -> DataFrame:
        return df.select(*narrow).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))

    def numbered(df: DataFrame, label: str) -> DataFrame:
        return written(df.withColumn("size", F.size("v")).withColumn("row", F.monotonically_increasing_id()), label)

    data, asked = numbered(ready(vectors), "vectors"), numbered(ready(queries).distinct(), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, top = data.agg(F.count("*"), F.max(square)).first()
    many = asked.agg(F.sum("size")).first()[0] or 0
    blocks, groups = max(1, -(-n // block)), max(1, -(-many // ASKED))
    left = data.select("*", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    right = asked.select("*", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("g"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b"))

    def meet(found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(found) and len(wanted):
            sizes = (np.stack(f["v"].to_numpy()) for f in (found, wanted))
            a, b = sizes
            rows = found["row"].to_numpy()
            for q, ids, scores, _, at in search(found["vec_id"].to_numpy(), a, wanted["vec_id"].to_numpy(), b, top, k, dims, sure):
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids, "row": rows[at], "score": scores}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "row": [], "score": []})
        return pd.concat(out) if out else empty

    keys = ["size", "b", "g"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, RESULT)
    # a candidate row counts once a query id, however many vectors have that id; one shuffle serves both groupings
    once = met.repartition("query_id").groupBy("query_id", "vec_id", "row").agg(F.min(-F.col("score")).alias("s"))
    # the least k of each query by (score, id); at most k rows a block and vector of the query go in
    best = once.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "vec_id", "row"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"),
    )


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))
