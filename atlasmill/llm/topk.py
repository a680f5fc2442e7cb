"""Exact top-k search by inner product of integer vectors.

Queries and candidates are dealt to a grid: a tile is one group of queries and one shard of
candidates. A tile is worked on in blocks: one product of all its queries and candidates, then a partial
selection for all queries at once that keeps every score not below a query's k-th (so ties survive), then
the k best by (score, id). The tiles' lists are merged in a tree, ``FAN_IN`` lists of a query at a time,
until one is left.

Products are in float64 as long as every partial sum is below 2 ** 53, and thus exact, whatever the
order of adding; larger components take Python's integers. A score outside the range of a long is
returned as the nearest long (ranks still follow the exact score). Vectors that are null, empty, or
hold a null or a component that is not finite take no part, as do rows with a null id. Vectors meet
only vectors of their own length. Rows that share a query's id are not its candidates; a query that
is repeated is answered once, with its least vector; repeated candidates count each. Very long vectors
are read whole. An empty table gives an empty result. Of the input only the id and the vector are read, so
columns that bear the name of a result do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 10
SCALE = 1024
QUERY_GROUP, SHARD, BLOCK = 8192, 16384, 2048
FAN_IN = 32
_EXACT = 2.0**53
_LONG = (1 << 63) - 1


def _whole(y):
    """floor(y) as a double; from 1e15 on a double has no fraction worth a floor that could overflow."""
    return F.when(F.abs(y) < 1e15, F.floor(y).cast("double")).otherwise(y)


def usable(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v: array of whole doubles) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)
    return df.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(good).filter(~F.coalesce(bad, F.lit(True))).select("vec_id", F.transform("v", lambda x: _whole(x * F.lit(float(scale)))).alias("v"))


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each ``row``: higher scores first, then smaller ids."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -scores[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    begins = np.flatnonzero(np.diff(row, prepend=-1)) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
    return row[place < k], ids[place < k], scores[place < k]


def _block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, candidate, score) of the k best of each query in one block."""
    scores = q @ c.T
    other = c_ids[None, :] != q_ids[:, None]
    if scores.dtype == object:
        row, col = np.nonzero(other)
    else:
        scores[~other] = -np.inf
        if len(c_ids) > k:
            at = len(c_ids) - k
            other &= scores >= np.partition(scores, at, axis=1)[:, at : at + 1]
        row, col = np.nonzero(other)
    return _first(row, c_ids[col], scores[row, col], k)


def top_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[list, list, list]:
    """(query, candidate, score) lists of every query's k best candidates in this tile."""
    whole = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < _EXACT
    if not whole:
        as_int = np.frompyfunc(int, 1, 1)
        q, c = as_int(q), as_int(c)
    queries, found, values = [], [], []
    for first in range(0, len(q_ids), BLOCK):
        mine, own = q_ids[first : first + BLOCK], q[first : first + BLOCK]
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64 if whole else object)
        for low in range(0, len(c_ids), BLOCK):
            best = _block(mine, own, c_ids[low : low + BLOCK], c[low : low + BLOCK], k)
            held = _first(*(np.concatenate(pair) for pair in zip(held, best, strict=True)), k)
        row, ids, scores = held
        queries += mine[row].tolist()
        found += ids.tolist()
        values += [int(x) for x in scores.tolist()]
    return queries, found, values


def _beyond(score: int) -> str:
    """Empty for a long; for other scores a text that orders them as the scores do (among those clipped to the same long)."""
    digits = str(abs(score))
    if score > _LONG:
        return f"{len(digits):06d}{digits}"
    if score < -_LONG - 1:
        return f"{999_999 - len(digits):06d}{''.join(str(9 - int(c)) for c in digits)}"
    return ""


def _tile(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        queries, found, values = [], [], []
    else:
        queries, found, values = top_of_tile(left.column("q_id").to_numpy(), _rows(left.column("q_v")), right.column("vec_id").to_numpy(), _rows(right.column("v")), k)
    shard = right.column("shard")[0].as_py() if right.num_rows else 0
    return pa.table({"query_id": pa.array(queries, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array([max(-_LONG - 1, min(_LONG, v)) for v in values], pa.int64()), "beyond": pa.array([_beyond(v) for v in values], pa.string()), "shard": pa.array([shard] * len(queries), pa.int32())})


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose id is divisible by ``every``."""
    ready = usable(vectors, id_col, vector_col, scale).withColumn("dim", F.size("v"))
    asked = ready.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    rows, queries = ready.count(), asked.count()
    shards, groups = max(1, math.ceil(rows / SHARD)), max(1, math.ceil(queries / QUERY_GROUP))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = asked.select(F.col("vec_id").alias("q_id"), F.col("v").alias("q_v"), F.col("dim").alias("q_dim"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("q_group"), each(shards).alias("q_shard"))
    c = ready.select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"), each(groups).alias("group"))
    tiles = q.groupBy("q_dim", "q_group", "q_shard").cogroup(c.groupBy("dim", "group", "shard"))
    lists = tiles.applyInArrow(lambda a, b: _tile(a, b, k), "query_id long, vec_id long, score long, beyond string, shard int")
    order = [F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id")]
    merged = lists
    while shards > 1:  # one level of the tree: FAN_IN lists of a query become one
        shards = -(-shards // FAN_IN)
        nodes = merged.withColumn("shard", F.expr(f"shard div {FAN_IN}"))
        merged = nodes.withColumn("r", F.row_number().over(W.partitionBy("query_id", "shard").orderBy(*order))).filter(F.col("r") <= k).drop("r")
    ranked = merged.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
