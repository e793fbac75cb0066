"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks of bounded size. The index of a block is one sorted array per random
projection. A query opens a window around its own value in every array and widens all windows level by
level (a larger radius is a wider window over the same arrays, so nothing is hashed again). A vector
inside the windows of enough projections is verified by its exact cosine. A query is done in a block when
its windows are so wide that a vector nearer than its k-th best would have been counted often enough
with the asked probability.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.llm.frames import ship, spark_schema
from tidewake.session import stage

PROJECTIONS = 64
SHARE = 0.7  # of the projections in which a vector has to collide
RECALL = 0.97  # probability that a true neighbour is verified
BLOCK_VALUES = 1 << 18  # components of the vectors of one block
QUERY_VALUES = 1 << 16  # components of the queries that meet a block in one task
FIRST_WINDOW, WIDER = 0.05, 1.4

_FOUND = pa.schema(
    [("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


@lru_cache(maxsize=4)
def directions(dim: int, projections: int) -> np.ndarray:
    """Random directions, the same in every task."""
    return np.random.default_rng(dim * 1009 + projections).standard_normal((projections, dim))


@lru_cache(maxsize=4)
def window_per_distance(projections: int, least: int, recall: float) -> float:
    """Half width, as a multiple of a vector's distance, at which it collides ``least`` times with that probability."""

    def enough(p: float) -> float:
        return sum(math.comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(least, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if enough(middle) < recall else (low, middle)
    # The difference of two unit vectors, projected, is normal with their distance as deviation.
    return NormalDist().inv_cdf((1 + min(high, 1 - 1e-12)) / 2)


def _matrix(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, their lengths), scaled by powers of two, which changes no cosine and keeps squares finite."""
    lists = table.column("vector").combine_chunks()
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, np.sqrt((x * x).sum(axis=1))


def _ids(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    values = table.column(column).combine_chunks()
    return values.fill_null(0).to_numpy(zero_copy_only=False), values.is_null().to_numpy(zero_copy_only=False)


def search_block(block: pa.Table, asked: pa.Table, k: int, projections: int, share: float, recall: float) -> pa.Table:
    """The ``k`` best verified vectors of a block for each query."""
    if not block.num_rows or not asked.num_rows:
        return _FOUND.empty_table()
    dim = block.column("dim")[0].as_py()
    x, x_length = _matrix(block, dim)
    q, q_length = _matrix(asked, dim)
    n, least = len(x), max(1, math.ceil(share * projections))
    ids, no_id = _ids(block, "vec_id")
    keys, _ = _ids(block, "key")
    q_ids, q_keys = asked.column("vec_id").to_pylist(), _ids(asked, "key")[0]

    lines = directions(dim, projections)
    values = lines @ (x / x_length[:, None]).T
    order = np.argsort(values, axis=1)
    values = np.take_along_axis(values, order, axis=1)
    centre = (q / q_length[:, None]) @ lines.T
    per_distance = window_per_distance(projections, least, recall)
    widths = FIRST_WINDOW * WIDER ** np.arange(math.ceil(math.log(2 * per_distance / FIRST_WINDOW, WIDER)) + 1)
    levels = len(widths)
    # Window borders of every query, level and projection; the level after the last takes in everything.
    low = np.zeros((len(q), levels + 1, projections), np.int64)
    high = np.full((len(q), levels + 1, projections), n, np.int64)
    for j in range(projections):
        low[:, :levels, j] = np.searchsorted(values[j], centre[:, j, None] - widths, "left")
        high[:, :levels, j] = np.searchsorted(values[j], centre[:, j, None] + widths, "right")

    found: list[tuple[list, list, list, list]] = []
    for i in range(len(q)):
        count = np.zeros(n, np.int64)
        candidates, scores = np.zeros(0, np.int64), np.zeros(0)
        open_ = np.ones(n, bool)
        # A row is no candidate for itself; other rows of the same vector are.
        if q_ids[i] is not None:
            open_ &= ~((ids == q_ids[i]) & ~no_id & (keys == q_keys[i]))
        left = right = None
        for level in range(levels + 1):
            a, b = low[i, level], high[i, level]
            if left is None:
                new = [order[j, s:e] for j, (s, e) in enumerate(zip(a.tolist(), b.tolist())) if s < e]
            else:
                new = [order[j, s:e] for j, (s, e) in enumerate(zip(a.tolist(), left.tolist())) if s < e]
                new += [order[j, s:e] for j, (s, e) in enumerate(zip(right.tolist(), b.tolist())) if s < e]
            left, right = a, b
            if new:
                count += np.bincount(np.concatenate(new), minlength=n)
                hit = np.flatnonzero((count >= least) & open_)
                if len(hit):
                    open_[hit] = False
                    candidates = np.concatenate([candidates, hit])
                    scores = np.concatenate([scores, (x[hit] * q[i]).sum(axis=1) / (x_length[hit] * q_length[i])])
            if len(candidates) >= k and level < levels:
                worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                if per_distance * math.sqrt(max(0.0, 2 - 2 * worst)) <= widths[level]:
                    break
        best = np.lexsort((ids[candidates], no_id[candidates], -scores))[:k]
        chosen = candidates[best]
        found.append(([q_ids[i]] * len(best), [int(q_keys[i])] * len(best), chosen, scores[best]))
    picked = pa.array(np.concatenate([f[2] for f in found]))
    return pa.Table.from_arrays(
        [
            pa.array([v for f in found for v in f[0]], pa.int64()),
            pa.array([v for f in found for v in f[1]], pa.int64()),
            block.column("vec_id").combine_chunks().take(picked),
            pa.array(np.concatenate([f[3] for f in found])),
        ],
        schema=_FOUND,
    )


def _blocks(components: int, values: int) -> int:
    return max(1, -(-components // values))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    projections: int = PROJECTIONS,
    share: float = SHARE,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_values: int = BLOCK_VALUES,
    query_values: int = QUERY_VALUES,
) -> DataFrame:
    """Per query the ``k`` rows of largest cosine that were found: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column vec_id; every other row is a candidate. A null or empty
    vector, one of zeros only and one with a null or non-finite component take no part; vectors of unlike
    length do not meet. Ties go to the smaller id, a null id last. Rows equal in id and vector are one
    row; rows of one id with different vectors are different rows, each with its own neighbours. All
    candidates come if there are fewer than ``k``. Other columns are not read; an empty table gives no
    rows. Scores are exact; a neighbour is missed with probability at most 1 - ``recall``.

    Blocks hold ``block_values`` components, so a task's memory does not grow with the input; queries
    meet a block in parts of ``query_values`` components.
    """
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))
    rows = vectors.filter(usable).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).distinct()
    rows = rows.select("vec_id", "vector", F.size("vector").alias("dim"), F.xxhash64("vector").alias("key"))
    rows = stage(rows.withColumn("asks", F.coalesce(is_query, F.lit(False))), "vectors")
    size = rows.agg(F.sum("dim").cast("long").alias("all"), F.sum(F.when(F.col("asks"), F.col("dim"))).cast("long").alias("asked")).first()
    blocks, parts = _blocks(size["all"] or 0, block_values), _blocks(size["asked"] or 0, query_values)

    spread = F.xxhash64("vec_id", "key")
    block = F.pmod(spread, F.lit(blocks)).cast("int").alias("block")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    part = F.pmod(F.xxhash64("key", "vec_id"), F.lit(parts)).cast("int").alias("part")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    index = rows.select("vec_id", "vector", "dim", "key", block, every_part)
    asked = rows.filter("asks").select("vec_id", "vector", "dim", "key", every_block, part)
    meet = ["dim", "block", "part"]
    found = index.groupBy(*meet).cogroup(asked.groupBy(*meet)).applyInArrow(
        lambda left, right: search_block(left, right, k, projections, share, recall), spark_schema(_FOUND)
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
