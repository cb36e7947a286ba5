"""Exact top-k inner products by no-random-access (NRA) aggregation of sorted lists.

Every dimension of a block of vectors is one sorted list; a query with a positive weight reads it
from the largest value down, with a negative weight from the smallest up. After reading to a depth,
an entry that was read contributes its value to both bounds of its vector; an unread one is at most
the list's frontier (upper bound) and at least the list's far end (lower bound). A query stops at the
first depth where few vectors have an upper bound at or above the k-th best lower bound: all others
cannot qualify, not even by a tie. The survivors' final scores are then resolved in exact integers.

Vectors and queries are dealt into blocks of bounded size; each pair of blocks is one group (a stated
query set against all rows), and the blocks' k best per query meet in a ranked window whose input is
limited to k rows per block. All queries of a block read the lists together, so the bounds of a depth
are a few matrix products.

Defined results: vectors that are null or hold a null or non-finite component, and rows without an
id, take no part; rows of one id count once (the smallest vector); vectors of different lengths are
compared over their common length; an empty vector scores 0. Scores beyond 64 bits are clamped after
ranking by the exact value. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialise

DEPTHS = (0.25, 0.5, 0.75, 0.9, 1.0)  # shares of a list that are read before bounds are compared
SAFE = 2.0 ** 52  # float64 sums below this are exact integers
LONG = 2 ** 63 - 1


def padded(t: pa.Table, name: str) -> np.ndarray:
    """A list column as a float64 matrix, rows padded with zeros."""
    col = t.column(name).combine_chunks()
    lens = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    width = int(lens.max()) if len(lens) else 0
    if len(lens) and (lens == width).all():
        return flat.reshape(len(lens), width)
    out = np.zeros((len(lens), width), np.int64)
    out[np.arange(width) < lens[:, None]] = flat
    return out


def nra_block(vec: np.ndarray, ids: np.ndarray, qry: np.ndarray, qids: np.ndarray, k: int) -> list[tuple]:
    """(query, vector, score) of the k best of one block; ties to smaller ids."""
    d = min(vec.shape[1], qry.shape[1])
    vec, qry, n = vec[:, :d], qry[:, :d], len(ids)
    out = []

    def resolve(q: int, rows: np.ndarray) -> None:
        if exact:
            scores = vec[rows] @ qry[q]
        else:
            scores = [sum(int(a) * int(b) for a, b in zip(vec[r], qry[q], strict=True)) for r in rows]
        best = sorted((-int(s), int(ids[r])) for s, r in zip(scores, rows, strict=True))[:k]
        out.extend((int(qids[q]), i, -s) for s, i in best)

    exact = d == 0 or float(np.abs(vec).max(initial=0)) * float(np.abs(qry).max(initial=0)) * d < SAFE
    own = ids[None, :] == qids[:, None]
    active = np.arange(len(qids))
    if exact and d:
        lists = np.sort(vec, axis=0)
        v = vec.astype(np.float64)
        for share in DEPTHS:
            t = max(1, math.ceil(share * n))
            top, low = lists[n - t], lists[t - 1]
            qp, qn = np.maximum(qry[active], 0).astype(np.float64), np.minimum(qry[active], 0).astype(np.float64)
            upper = qp @ np.maximum(v, top).T + qn @ np.minimum(v, low).T
            lower = qp @ np.where(v >= top, v, lists[0]).T + qn @ np.where(v <= low, v, lists[-1]).T
            upper[own[active]] = -np.inf
            lower[own[active]] = -np.inf
            kth = np.partition(lower, max(0, n - k), axis=1)[:, max(0, n - k)]
            survive = (upper >= kth[:, None]) & ~own[active]
            few = survive.sum(axis=1) <= 8 * k
            if share == DEPTHS[-1]:
                few[:] = True
            for j in np.flatnonzero(few):
                resolve(active[j], np.flatnonzero(survive[j]))
            active = active[~few]
            if not len(active):
                break
    else:
        for q in active:
            resolve(q, np.flatnonzero(~own[q]))
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, block: int = 1024, query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose id divides by ``every``."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    quantised = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = materialise(
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ok)
        .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(quantised).alias("vec")))
    asks = rows.where(F.col("vec_id") % every == 0)
    n_blocks = max(1, -(-rows.count() // block))
    n_asks = max(1, -(-asks.count() // query_block))
    left = rows.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("vb"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1))).alias("qb"))
    right = asks.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_asks)).cast("int").alias("qb"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("vb"))

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))])

    def run(vecs: pa.Table, qrys: pa.Table) -> pa.Table:
        found = []
        if vecs.num_rows and qrys.num_rows:
            found = nra_block(padded(vecs, "vec"), vecs.column("vec_id").to_numpy(),
                              padded(qrys, "vec"), qrys.column("vec_id").to_numpy(), k)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), schema, strict=False)] if found
                        else [pa.array([], f.type) for f in schema], schema=schema)

    found = (left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb"))
             .applyInArrow(run, "query_id long, vec_id long, score decimal(38,0)"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    clamped = F.least(F.greatest(F.col("score"), F.lit(-LONG - 1).cast("decimal(38,0)")),
                      F.lit(LONG).cast("decimal(38,0)")).cast("long")
    return best.select("query_id", "rank", "vec_id", clamped.alias("score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
