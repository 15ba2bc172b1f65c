"""Exact top-k inner-product search by no-random-access aggregation of sorted lists (dealt operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.store import written

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
# Depths (share of each list) after which the bounds are compared; at the end of the lists both bounds are the score.
DEPTHS = (1 / 8, 1 / 4, 1 / 2, 3 / 4, 1)
# Reading stops once at most this share of a tile's pairs can still qualify; those scores are resolved exactly.
SURVIVORS = 0.04
_LONG = 2**63 - 1


def finite_vector(vec: Column) -> Column:
    """True for a vector without null or non-finite components (null for a null vector)."""
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def _resolve(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    out = np.empty(len(qi), q.dtype)
    for a in range(0, len(qi), 65_536):
        out[a : a + 65_536] = np.einsum("ij,ij->i", q[qi[a : a + 65_536]], x[xi[a : a + 65_536]])
    return out


def tile_topk(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int,
              progress: list[tuple[int, int]] | None = None):
    """(query ids, candidate ids, scores): at least each query's k best of one block of candidates, ties included.

    One sorted list per component, read from its best end for the sign of the query's weight.  Having read a list
    to some depth, a seen entry counts its value, an unseen one at most the value at that depth (upper bound) and at
    least the list's last value (lower bound); nothing is looked up out of order.  Pairs whose upper bound is below
    the query's k-th best lower bound cannot qualify.  Reading goes on until few pairs remain, whose scores are resolved,
    or to the ends of the lists, where the lower bounds are the scores.  `progress` gets (entries read of each list, pairs
    that can still qualify) after each comparison.
    """
    n, d = x.shape
    bound = float(max(1, d)) * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if bound >= 2**53:  # beyond exact doubles: whole numbers of any size, clipped to long
        score = np.clip(q.astype(object) @ x.astype(object).T, -_LONG - 1, _LONG)
        keep = qid[:, None] != xid[None, :]
        qi, xi = np.nonzero(keep)
        return _best(qid, xid, qi, xi, score[qi, xi].astype(np.int64), k)
    kind = np.float32 if bound < 2**24 else np.float64
    q, x = q.astype(kind), x.astype(kind)
    up_q, down_q = np.maximum(q, 0), np.minimum(q, 0)
    order = np.argsort(x, axis=0, kind="stable")
    lists, cols = np.take_along_axis(x, order, 0), np.arange(d)
    own = qid[:, None] == xid[None, :]
    first, last = lists[0], lists[-1]
    seen_up, seen_down = np.zeros((n, d), bool), np.zeros((n, d), bool)
    known_up, known_down = np.zeros((n, d), kind), np.zeros((n, d), kind)
    read, alive = 0, ~own
    for share in DEPTHS:
        depth = int(np.ceil(n * share))
        if depth == read:
            continue
        top, bottom = order[n - depth : n - read], order[read:depth]
        seen_up[top, cols], known_up[top, cols] = True, lists[n - depth : n - read]
        seen_down[bottom, cols], known_down[bottom, cols] = True, lists[read:depth]
        read = depth
        upper = up_q @ np.where(seen_up, known_up, lists[n - depth]).T
        upper += down_q @ np.where(seen_down, known_down, lists[depth - 1]).T
        lower = up_q @ np.where(seen_up, known_up, first).T
        lower += down_q @ np.where(seen_down, known_down, last).T
        lower[own] = -np.inf
        if n > k:  # otherwise every pair qualifies
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
            alive = (upper >= kth[:, None]) & ~own
        if progress is not None:
            progress.append((read, int(alive.sum())))
        if read == n:
            qi, xi = np.nonzero(alive)
            return _best(qid, xid, qi, xi, lower[qi, xi].astype(np.int64), k)
        if alive.sum() <= max(4 * k * len(q), SURVIVORS * alive.size):
            break
    qi, xi = np.nonzero(alive)
    return _best(qid, xid, qi, xi, _resolve(q, x, qi, xi).astype(np.int64), k)


def _best(qid, xid, qi, xi, score, k):
    by = np.lexsort((xid[xi], ~score, qi))  # ~: the order of -score without its overflow
    qi, xi, score = qi[by], xi[by], score[by]
    starts = np.searchsorted(qi, qi)
    keep = np.arange(len(qi)) - starts < k
    return qid[qi[keep]], xid[xi[keep]], score[keep]


def _pack(block: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        width = max(len(v) for v in pdf["vec"])
        m = np.zeros((len(pdf), width), np.int64)
        for i, v in enumerate(pdf["vec"]):
            m[i, : len(v)] = v
        small = np.abs(m).max(initial=0)
        m = m.astype(np.int16 if small < 2**15 else np.int64)
        return pd.DataFrame({block: [int(pdf[block].iloc[0])], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "width": [width], "item": [m.dtype.itemsize], "mat": [m.tobytes()]})

    return run


def _blocks(vecs: DataFrame, count: int, size: int, block: str) -> tuple[DataFrame, int]:
    n = max(1, -(-count // size))
    cut = vecs.withColumn(block, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    packed = cut.groupBy(block).applyInPandas(
        _pack(block), f"{block} int, ids binary, width int, item int, mat binary")
    return packed.select(block, F.struct("ids", "width", "item", "mat").alias("data")), n


def _open(data: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.frombuffer(data["mat"], np.int16 if data["item"] == 2 else np.int64).astype(np.int64)
    ids = np.frombuffer(data["ids"], np.int64)
    m = m.reshape(len(ids), data["width"])
    return ids, np.pad(m, ((0, 0), (0, width - data["width"])))


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller vec_id.

    queries and candidates: (id: long, vec: array<long>).  Both are packed into blocks of bounded size; each pair of
    blocks is one row, searched by no-random-access aggregation (`tile_topk`); the blocks' best are merged by a
    grouped rank with a partial top-k before its shuffle.  A query is never its own candidate.

    Rows with null id or vector take no part.  A repeated id counts once, with its smallest vector.  Vectors of
    unequal length are compared as if padded with zeros.  Scores beyond long are clipped.  With fewer than k
    candidates all are returned; an empty side gives no rows.
    """
    once = [written(df.where("id is not null and vec is not null").groupBy("id").agg(F.min("vec").alias("vec")),
                    "topk-vectors") for df in (queries, candidates)]
    counts = [df.count() for df in once]
    qs, nq = _blocks(once[0], counts[0], QUERY_BLOCK, "qb")
    xs, nx = _blocks(once[1], counts[1], CANDIDATE_BLOCK, "xb")
    qs = qs.withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(nx - 1)))).withColumnRenamed("data", "q")
    xs = xs.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))).withColumnRenamed("data", "x")
    # As many partitions as tiles: the work is in the tiles, not in their bytes.
    tasks = max(1, min(nq * nx, 100_000))
    tiles = qs.repartition(tasks, "qb", "xb").join(xs.repartition(tasks, "qb", "xb"), ["qb", "xb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, x = (batch.column(c)[i].as_py() for c in ("q", "x"))
                width = max(1, q["width"], x["width"])
                qid, qm = _open(q, width)
                xid, xm = _open(x, width)
                got = tile_topk(qm, qid, xm, xid, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["query_id", "vec_id", "score"])

    found = tiles.select("q", "x").mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
