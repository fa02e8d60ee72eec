"""Operator 1, exact top-k search by block-max pruning.

Vectors are ranged into blocks of similar vectors; a block stores its forward index (ids and integer
components) and, per dimension, the largest and smallest component: the maxima of the terms "dimension,
positive" and "dimension, negative". A query adds up its terms' maxima to a bound per block, visits
blocks in falling order of the bound and stops when the bound is below its kth score. Blocks are grouped
in shards; (shard, batch of queries) groups run in parallel and the k best of each shard are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BLOCK = 256              # vectors of a block
SHARD_BLOCKS = 64        # blocks of a shard
QUERY_BATCH = 1024       # queries that visit a shard together
PIVOTS = 64              # rows whose directions order the vectors into blocks (layout only)
EXACT = 2.0 ** 53        # sums below this are exact in float64


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float = 256.0) -> DataFrame:
    """(id, v): floor(scale * x) of every component as long; rows with a null id or a null or non-finite
    component are left out, a repeated id keeps its greatest vector."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (df.where(ok).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))
            .groupBy("id").agg(F.max("v").alias("v")))


def _matrix(vectors: list, d: int) -> np.ndarray:
    """Rows of integers, short ones padded with 0."""
    m = np.zeros((len(vectors), d), dtype=np.int64)
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T: float64 while every sum stays exact, Python integers beyond."""
    peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if peak < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -2**63, 2**63 - 1).astype(np.int64)


def block_topk(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[list[tuple], int]:
    """The k best of these blocks for each query, and the number of blocks scored.

    ``blocks``: (ids, matrix) each. Rows of the result: (query_id, vec_id, score); a query's own id is no
    candidate; ties go to the smaller vec_id, so a block whose bound equals the kth score is still scored.
    """
    hi = np.stack([m.max(axis=0) for _, m in blocks])
    lo = np.stack([m.min(axis=0) for _, m in blocks])
    bounds = _dot(np.maximum(q, 0), hi) + _dot(np.minimum(q, 0), lo)
    small = float(np.abs(q).max(initial=0)) * max(float(np.abs(hi).max(initial=0)), float(np.abs(lo).max(initial=0))) * q.shape[1] < EXACT
    forward = [(ids, m.astype(np.float64) if small else m) for ids, m in blocks]
    order = np.argsort(-bounds, axis=1, kind="stable")
    out, scored = [], 0
    for i, me in enumerate(q_ids):
        row = q[i].astype(np.float64) if small else q[i:i + 1]
        best_s, best_i, kth = np.empty(0, np.int64), np.empty(0, np.int64), None
        for b in order[i]:
            if kth is not None and bounds[i, b] < kth:
                break
            ids, m = forward[b]
            scored += 1
            s = (m @ row).astype(np.int64) if small else _dot(row, m)[0]
            keep = ids != me
            if kth is not None:
                keep &= s >= kth
            if not keep.any():
                continue
            s, ids = np.concatenate([best_s, s[keep]]), np.concatenate([best_i, ids[keep]])
            top = np.lexsort((ids, -s))[:k]
            best_s, best_i = s[top], ids[top]
            if len(best_s) == k:
                kth = best_s[-1]
        out += [(int(me), int(a), int(b)) for a, b in zip(best_i, best_s)]
    return out, scored


def top_k(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """Exact k highest integer inner products of every query row with all other rows.

    Returns query_id, rank (from 1), vec_id, score; ties to the smaller vec_id; fewer than k rows where
    fewer candidates exist. Vectors null, holding null or non-finite components, or without an id take no
    part, neither as query nor as candidate; empty vectors and missing trailing components count as 0;
    of rows that repeat an id the greatest vector counts; scores beyond a long stop at its ends. Empty
    tables give an empty result. Extra columns play no part.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "topk")
    rows = scratch.table(integer_vectors(df, id_col, vec_col, scale), "vectors")
    n, d = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    d = max(int(d or 0), 1)
    pivots = [r[0] for r in rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("v").collect()]  # at most PIVOTS rows
    pivot_m = _matrix(pivots, d).astype(np.float64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = _matrix(b["v"].tolist(), d).astype(np.float64)
            yield pd.DataFrame({"id": b["id"], "near": (m @ pivot_m.T).argmax(axis=1), "v": b["v"]})

    shards = max(1, math.ceil(n / (BLOCK * SHARD_BLOCKS)))
    ranged = rows.mapInPandas(place, "id long, near long, v array<long>").repartitionByRange(shards, "near", "id").sortWithinPartitions("near", "id")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                part = b.iloc[at:at + BLOCK]
                yield pd.DataFrame({"shard": part["shard"].iloc[:1].tolist(), "first": [int(part["id"].iloc[0])],
                                    "ids": [part["id"].to_numpy(np.int64).tobytes()], "m": [_matrix(part["v"].tolist(), d).astype(np.int64).tobytes()]})

    blocks = scratch.table(ranged.withColumn("shard", F.spark_partition_id().cast("long")).mapInPandas(
        build, "shard long, first long, ids binary, m binary"), "blocks")
    q = integer_vectors(queries, id_col, vec_col, scale)
    batches = max(1, math.ceil(queries.count() / QUERY_BATCH))
    q = q.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)))
    ids = spark.range(shards).select(F.col("id").alias("shard"))
    at_shards = q.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    at_batches = blocks.join(ids, "shard", "left_semi").withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        bs = [(np.frombuffer(i, np.int64), np.frombuffer(m, np.int64).reshape(-1, d)) for i, m in zip(right["ids"], right["m"])]
        found, _ = block_topk(left["id"].to_numpy(np.int64), _matrix(left["v"].tolist(), d), bs, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    near = at_shards.groupBy("shard", "batch").cogroup(at_batches.groupBy("shard", "batch")).applyInPandas(
        score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
