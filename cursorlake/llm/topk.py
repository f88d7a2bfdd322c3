"""Exact top-k by inner product, selected by distributed score histograms.

A stated query set is compared with all rows, in blocks of queries of bounded
size. For a block, every task scores its rows against all queries of the block:

1. bracket: the best k-th score within any one task is a lower bound of the
   global k-th score, the best score an upper bound;
2. histogram: tasks count their scores in equal bins of each query's bracket;
   the summed counts tell the bin that holds the k-th score, which becomes the
   new bracket, until few scores lie above its lower end or it is one value wide;
3. filter: scores at or above the lower end are ranked, ties to smaller ids. A
   task sends at most its own best k per query, so even thousands of equal
   vectors stay k rows a task.

Vectors are integers: floor(scale * x) for each component x. A vector that is
null or holds a null or non-finite component takes no part; a shorter vector
counts as padded with zeros. Rows that repeat an id are rows like others, but a
query never meets a row of its own id; queries that repeat an id count once, by
their largest vector. Fewer candidates than k: all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import frames, staged, text_batches

QUERY_BLOCK = 2048
CHUNK = 1024
BINS = 256
NEAR = 64
NONE = np.iinfo(np.int64).min
EXACT = 2.0**53


def quantized(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, v): usable vectors as floor(scale * x), packed doubles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield from frames({"vec_id": b["vec_id"], "v": [
                np.floor(scale * np.asarray(x, "<f8")).tobytes() for x in b["x"]]})

    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select("vec_id", "x") \
        .mapInPandas(run, "vec_id long, v binary")


def _matrix(packed, width: int) -> np.ndarray:
    rows = [np.frombuffer(x, "<f8") for x in packed]
    if all(len(r) == width for r in rows):
        return np.stack(rows) if rows else np.zeros((0, width))
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r[:width]
    return out


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of a long they stop at
    its ends."""
    size = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if size < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in q], object).dot(np.array([[int(x) for x in r] for r in c], object).T)
    return np.clip(whole, NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


def _scored(block: tuple[np.ndarray, np.ndarray], task: Callable) -> Callable:
    """A mapInPandas function that hands ``task`` (scores, candidate ids) of
    each chunk of rows and yields what it returns at the end."""
    ids, q = block

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, end = task()
        for b in batches:
            for at in range(0, len(b), CHUNK):
                c_ids = b["vec_id"].to_numpy(np.int64)[at: at + CHUNK]
                scores = inner_products(q, _matrix(b["v"][at: at + CHUNK], q.shape[1]))
                scores[ids[:, None] == c_ids] = NONE
                step(scores, c_ids)
        yield from frames(end())

    return run


def _bracket(ids: np.ndarray, k: int) -> Callable:
    def task():
        best = np.full((len(ids), k), NONE)
        low = np.full(len(ids), np.iinfo(np.int64).max)

        def step(scores, _):
            nonlocal best
            both = np.concatenate([best, scores], 1)
            best = np.partition(both, both.shape[1] - k, 1)[:, -k:]
            np.minimum(low, np.where(scores == NONE, np.iinfo(np.int64).max, scores).min(1), out=low)

        def end():
            some = best.max(1) > NONE
            kth = pd.Series(best.min(1)).astype("Int64").mask(best.min(1) == NONE)
            return {"query_id": ids[some], "kth": kth[some].to_numpy(), "low": low[some], "high": best.max(1)[some]}
        return step, end
    return task


def _histogram(ids, low, width) -> Callable:
    def task():
        counts = np.zeros(len(ids) * BINS, np.int64)

        def step(scores, _):
            q, c = np.nonzero(scores >= low[:, None])
            above = scores[q, c].astype(np.uint64) - low[q].astype(np.uint64)  # a bracket may be wider than a long
            bins = np.minimum(above // width[q].astype(np.uint64), BINS - 1).astype(np.int64)
            counts[:] += np.bincount(q * BINS + bins, minlength=len(counts))

        def end():
            used = np.flatnonzero(counts)
            return {"query_id": ids[used // BINS], "bin": used % BINS, "n": counts[used]}
        return step, end
    return task


def _filter(ids, low, k: int) -> Callable:
    def task():
        held = []

        def best(rows):
            q, s, v = (np.concatenate(x) for x in zip(*rows))
            order = np.lexsort((v, -s, q))
            q, s, v = q[order], s[order], v[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            return q[rank < k], s[rank < k], v[rank < k]

        def step(scores, c_ids):
            q, c = np.nonzero(scores >= low[:, None])
            if len(q):
                held.append((q, scores[q, c], c_ids[c]))
            if len(held) > 16:
                held[:] = [best(held)]

        def end():
            q, s, v = best(held) if held else (np.zeros(0, int),) * 3
            return {"query_id": ids[q], "vec_id": v, "score": s}
        return step, end
    return task


def _block_top_k(rows: DataFrame, block: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of one block of queries."""
    ids = block[0]

    def over(task: Callable, schema: str) -> DataFrame:
        return rows.mapInPandas(_scored(block, task), schema)

    # The collected rows below are one per query of the block, QUERY_BLOCK or so.
    got = over(_bracket(ids, k), "query_id long, kth long, low long, high long").groupBy("query_id").agg(
        F.coalesce(F.max("kth"), F.min("low")).alias("low"), F.max("high").alias("high")).toPandas().set_index("query_id")
    low = got["low"].reindex(ids).fillna(0).to_numpy(np.int64)
    high = got["high"].reindex(ids).fillna(0).to_numpy(np.int64)
    open_ = np.isin(ids, got.index)
    while open_.any():
        span = [int(h) - int(l) + 1 for h, l in zip(high, low)]  # may pass the range of a long
        width = np.array([max(1, -(-x // BINS)) for x in span], np.int64)
        at = np.flatnonzero(open_)
        counts = rows.mapInPandas(_scored((ids[at], block[1][at]), _histogram(ids[at], low[at], width[at])),
                                  "query_id long, bin int, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("bin")))
        found = counts.withColumn("above", above).where(F.col("above") >= k).groupBy("query_id").agg(
            F.max("bin").alias("bin"), F.min("above").alias("above")).toPandas().set_index("query_id")
        found = found.reindex(ids)
        has = open_ & found["bin"].notna().to_numpy()  # the others have fewer than k candidates in all
        bins = found["bin"].fillna(0).to_numpy(np.int64)
        new_low = low + bins * width
        last = bins == BINS - 1  # the last bin reaches up to the bracket's end
        high = np.where(has, np.where(last, high, new_low + width - 1), high)
        low = np.where(has, new_low, low)
        open_ = has & (found["above"].fillna(0).to_numpy() > NEAR + k) & (width > 1)
    kept = over(_filter(ids, low, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k best rows of every query row (``is_query`` over column vec_id)."""
    spark = vectors.sparkSession
    text_batches(spark, 4096)
    rows = staged(quantized(vectors, scale, id_col, vector_col), "topk-rows")
    queries = rows.where(is_query).groupBy("vec_id").agg(F.max("v").alias("v"))
    n = queries.count()
    blocks = max(1, -(-n // query_block))
    out = None
    for i in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).toPandas()
        if len(block):
            width = max(len(x) for x in block["v"]) // 8
            found = _block_top_k(rows, (block["vec_id"].to_numpy(np.int64), _matrix(block["v"], width)), k)
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
