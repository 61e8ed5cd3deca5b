"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; each segment keeps its mean and its deviation
(the norm of what is left without the mean). For two vectors with equal segments of
lengths n, the inner product is at most ``sum(n * mean_x * mean_y + dev_x * dev_y)``, by
Cauchy-Schwarz, which is the same as a lower bound on their distance. The bounds tighten
with the resolution, so candidates that stay below a query's current k-th best are left
out coarse to fine, and exact products are computed for the survivors only.

Queries and candidates are packed into blocks of bounded size; a block of queries meets
each block of candidates once, and a task keeps k rows a query. The k best of all tasks
are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
QUERY_ROWS = 512
EXACT_LIMIT = float(2 ** 53)


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v array<double>`` with ``floor(scale * x)`` in every place; rows with a null
    id, a null or empty vector, or a null or non-finite component take no part."""
    v = F.expr(f"transform(`{vector_col}`, x -> floor({scale}D * cast(x as double)))")
    raw = F.col(f"`{vector_col}`")
    fine = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & raw.isNotNull() & (F.size(raw) > 0) & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v")))


def levels(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per resolution: segment lengths, means * sqrt(length), deviations."""
    d, out, parts = m.shape[1], [], 1
    while parts < d and parts <= 16:
        edges = np.unique(np.linspace(0, d, parts + 1).astype(int))
        n = np.diff(edges)
        total = np.add.reduceat(m, edges[:-1], axis=1)
        square = np.add.reduceat(m * m, edges[:-1], axis=1)
        dev = np.sqrt(np.maximum(square - total * total / n, 0.0))
        out.append((n, total / np.sqrt(n), dev))
        parts *= 4
    return out


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; floats where they are exact, else whole numbers of any size."""
    high = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if high < EXACT_LIMIT:
        return (q @ c.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in c], dtype=object).T
    return np.clip(big, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, best: dict, k: int) -> None:
    """Update ``best[query] = [(−score, vec_id), ...]`` with the candidates of one block."""
    ql, cl = levels(q), levels(c)
    # rounding of the float bounds, far below 1 for scores that floats hold exactly
    slack = 1e-9 * (np.linalg.norm(q, axis=1).max(initial=0) * np.linalg.norm(c, axis=1).max(initial=0)) + 1e-6
    for i, query in enumerate(qid.tolist()):
        found = best.setdefault(query, [])
        at = np.arange(len(cid))
        start = 0
        if len(found) < k:  # the first candidates set the bound
            start = min(len(at), 4 * k)
            _merge(found, query, cid[:start], exact_products(q[i:i + 1], c[:start])[0], k)
            at = at[start:]
        for (_, qm, qd), (_, cm, cd) in zip(ql, cl, strict=True):
            if len(found) < k or not len(at):
                break
            bound = cm[at] @ qm[i] + cd[at] @ qd[i]
            at = at[bound + slack >= -found[-1][0]]
        if len(at):
            _merge(found, query, cid[at], exact_products(q[i:i + 1], c[at])[0], k)


def _merge(found: list, query: int, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    keep = ids != query
    ids, scores = ids[keep], scores[keep]
    if len(ids) > k:
        order = np.lexsort((ids, -scores))[:k] if len(found) < k else np.flatnonzero(scores >= -found[-1][0])
        ids, scores = ids[order], scores[order]
    found += zip((-int(s) for s in scores), ids.tolist(), strict=True)
    found.sort()
    del found[k:]


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """Rows packed into blocks ``(dim, ids, data)`` of one dimension and at most ``rows`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def emit(dim: int) -> pa.RecordBatch:
            ids, vs = held.pop(dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.asarray(ids, "<i8").tobytes()], pa.binary()),
                 pa.array([np.asarray(vs, "<f8").tobytes()], pa.binary())], names=["dim", "ids", "data"])

        for b in batches:
            for vec_id, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                values = v.values.to_numpy(zero_copy_only=False)
                ids, vs = held.setdefault(len(values), ([], []))
                ids.append(vec_id)
                vs.append(values)
                if len(ids) >= rows:
                    yield emit(len(values))
        for dim in list(held):
            yield emit(dim)

    return df.mapInArrow(run, "dim int, ids binary, data binary")


def top_products(queries: DataFrame, candidates: DataFrame, k: int = 5, chunks: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its k candidates (not itself) with the
    highest integer inner products, ties to the smaller id; fewer if there are fewer.

    Both sides are ``vec_id long, v array<double>`` of whole numbers (:func:`quantise`).
    Vectors of different lengths are not compared. Repeated rows are candidates as often
    as they occur; the answers of repeated query rows are merged. Scores beyond a long are held at its bounds. Empty tables give no rows.
    ``chunks`` is the number of candidate groups that every query block meets.
    """
    n = chunks or int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cand = (_blocks(candidates, BLOCK_ROWS)
            .withColumn("chunk", F.pmod(F.xxhash64("ids"), F.lit(n))))
    quer = (_blocks(queries, QUERY_ROWS)
            .select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                    F.explode(F.expr(f"sequence(0L, {n - 1}L)")).alias("chunk")))
    pairs = quer.join(cand, ["dim", "chunk"]).select("dim", "q_ids", "q_data", "ids", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for b in batches:
            for dim, qi, qd, ci, cd in zip(*(b.column(j).to_pylist() for j in range(5)), strict=True):
                qid, cid = np.frombuffer(qi, "<i8"), np.frombuffer(ci, "<i8")
                search_block(qid, np.frombuffer(qd, "<f8").reshape(-1, dim), cid,
                             np.frombuffer(cd, "<f8").reshape(-1, dim), best, k)
            if len(best) > 200_000:
                yield _rows(best)
                best = {}
        if best:
            yield _rows(best)

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rows(best: dict) -> pa.RecordBatch:
    flat = [(q, v, -s) for q, found in best.items() for s, v in found]
    cols = list(zip(*flat, strict=True)) if flat else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])
