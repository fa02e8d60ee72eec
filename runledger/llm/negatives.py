"""Operator 11, hard-negative mining by Kronecker-packed products.

Up to PACK candidates share one wide integer per dimension: each component, biased to be non-negative,
fills a field wide enough for a whole inner product. One multiplication per anchor component and a sum
over the dimensions put the biased products of all the pack's candidates into their fields; taking the
bias terms off gives the exact scores. (shard of packs, batch of anchors) groups run in parallel; a first
round finds every anchor's positives among its own label, a second one the negatives in their windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .search import _matrix

PACK = 2048     # candidates whose fields share one wide integer
SHARD = 8192    # candidates of a group
BATCH = 4096    # anchors of a group
LONG = 2 ** 63


def field_width(dims: int, a_span: int, c_span: int) -> int:
    """Bytes of a field that holds sum(a * c) over the dimensions for 0 <= a <= a_span, 0 <= c <= c_span."""
    return max(1, -(-(dims * max(1, a_span) * max(1, c_span)).bit_length() // 8))


def pack(m: np.ndarray, low: int, width: int) -> list[int]:
    """One wide integer per column of ``m`` (n candidates x dims): field i holds m[i, j] - low."""
    n, d = m.shape
    biased = m.astype(np.uint64) - np.uint64(low % 2 ** 64)  # below 2^64, as both ends are longs
    raw = np.zeros((d, n, max(width, 8)), np.uint8)
    raw[:, :, :8] = np.ascontiguousarray(biased.T).astype("<u8").view(np.uint8).reshape(d, n, 8)
    return [int.from_bytes(raw[j, :, :width].tobytes(), "little") for j in range(d)]


def unpack(total: int, n: int, width: int) -> np.ndarray:
    """The n fields of a wide integer: unsigned 64-bit where they fit, Python integers beyond."""
    raw = total.to_bytes(n * width, "little")
    if width > 8:
        return np.array([int.from_bytes(raw[i:i + width], "little") for i in range(0, n * width, width)], dtype=object)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(n, width)
    return out.view("<u8").ravel()


class Pack:
    """The candidates of one pack and their exact scores against an anchor."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, m: np.ndarray, a_low: int, a_high: int):
        n, d = m.shape
        self.ids, self.labels, self.n, self.a_low = ids, labels, n, a_low
        self.low = int(m.min(initial=0))
        span = int(m.max(initial=0)) - self.low
        self.width = field_width(d, a_high - a_low, span)
        self.fields = pack(m, self.low, self.width)
        far = max(abs(a_low), abs(a_high)) + 1, max(abs(self.low), abs(self.low + span)) + 1
        self.narrow = 4 * d * far[0] * far[1] < LONG  # then every term below stays a long
        sums = unpack(sum(self.fields), n, self.width)
        self.bias = a_low * (sums.astype(np.int64) if self.narrow else sums.astype(object)) + d * a_low * self.low

    def scores(self, anchor: list[int]) -> np.ndarray:
        """sum(a * c) of every candidate; beyond a long, its nearest end."""
        up = [a - self.a_low for a in anchor]
        total = sum(a * p for a, p in zip(up, self.fields) if a)
        got = unpack(total, self.n, self.width)
        if self.narrow:
            return got.astype(np.int64) + self.bias + self.low * sum(up)
        return np.clip(got.astype(object) + self.bias + self.low * sum(up), -LONG, LONG - 1).astype(np.int64)


def _rows(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, v) of the rows that take part; v is floor(scale * x) of every component."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.where(ok).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                               F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def hard_negatives(df: DataFrame, anchors: DataFrame, k_pos: int = 5, k_neg: int = 5, low: int = 80, high: int = 100,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: float = 256.0) -> DataFrame:
    """For every anchor and each of its ``k_pos`` best rows of the same label, the ``k_neg`` best rows of
    other labels with low * positive_score <= high * negative_score <= high * positive_score.

    Scores are integer inner products of floor(scale * x); higher ones come first, ties by smaller id.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Rows with
    a null id, label or vector, or a null or non-finite component take no part; empty vectors and missing
    trailing components count as 0; scores beyond a long stop at its ends. Rows that repeat an id are
    candidates each; an anchor's own id is none; anchors that repeat exactly count once, anchors that
    share an id only, each. Anchors without positives, or without negatives in a window, give no rows;
    empty tables give an empty result. Extra columns play no part.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = scratch.table(_rows(df, id_col, vec_col, label_col, scale), "vectors")
    asked = scratch.table(_rows(anchors, id_col, vec_col, label_col, scale).distinct().withColumn("akey", F.xxhash64("id", "label", "v")), "anchors")
    n, d = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n_asked, a_dims, a_low, a_high = asked.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    d = max(int(d or 0), int(a_dims or 0), 1)
    a_low, a_high = min(0, int(a_low or 0)), max(0, int(a_high or 0))
    shards, batches = max(1, math.ceil(n / SHARD)), max(1, math.ceil(n_asked / BATCH))

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            for at in range(0, len(b), PACK):
                part = b.iloc[at:at + PACK]
                yield pd.DataFrame({"shard": part["shard"].iloc[:1].tolist(), "ids": [part["id"].to_numpy(np.int64).tobytes()],
                                    "labels": [part["label"].tolist()], "m": [_matrix(part["v"].tolist(), d).tobytes()]})

    packs = scratch.table(rows.repartition(shards).withColumn("shard", F.spark_partition_id().cast("long")).mapInPandas(
        gather, "shard long, ids binary, labels array<string>, m binary"), "packs")
    at_batches = packs.withColumn("batch", _each(batches))

    def open_packs(right: pd.DataFrame) -> tuple[dict, list[Pack]]:
        codes, names = pd.factorize(np.concatenate([np.asarray(x, dtype=object) for x in right["labels"]]))
        out, at = [], 0
        for i, m in zip(right["ids"], right["m"]):
            ids = np.frombuffer(i, np.int64)
            out.append(Pack(ids, codes[at:at + len(ids)], np.frombuffer(m, np.int64).reshape(-1, d), a_low, a_high))
            at += len(ids)
        return {x: c for c, x in enumerate(names)}, out

    def best(ids: np.ndarray, scores: np.ndarray, k: int, had: tuple) -> tuple[np.ndarray, np.ndarray]:
        ids, scores = np.concatenate([had[0], ids]), np.concatenate([had[1], scores])
        top = np.lexsort((ids, -scores))[:k]
        return ids[top], scores[top]

    none = (np.empty(0, np.int64), np.empty(0, np.int64))

    def find_positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            names, opened = open_packs(right)
            for me, akey, label, v in zip(left["id"], left["akey"], left["label"], _matrix(left["v"].tolist(), d).tolist()):
                code, had = names.get(label), none
                for p in opened:
                    keep = (p.labels == code) & (p.ids != me) if code is not None else np.zeros(0, bool)
                    if keep.any():
                        had = best(p.ids[keep], p.scores(v)[keep], k_pos, had)
                out += [(me, akey, int(i), int(s)) for i, s in zip(*had)]
        return pd.DataFrame(out, columns=["id", "akey", "positive_id", "score"]).astype("int64")

    def find_negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            names, opened = open_packs(right)
            for me, akey, label, pos, v in zip(left["id"], left["akey"], left["label"], left["positives"], _matrix(left["v"].tolist(), d).tolist()):
                code = names.get(label, -1)
                windows = [(int(p["place"]), int(p["positive_id"]), int(p["score"]), -(-low * int(p["score"]) // high)) for p in pos]
                windows = [w for w in windows if w[3] <= w[2]]
                had = {w[0]: none for w in windows}
                if not windows:
                    continue
                floor, top = min(w[3] for w in windows), max(w[2] for w in windows)
                for p in opened:
                    keep = (p.labels != code) & (p.ids != me)
                    if not keep.any():
                        continue
                    s = p.scores(v)
                    keep &= (s >= floor) & (s <= top)
                    ids, s = p.ids[keep], s[keep]
                    for place, _, score, least in windows if len(s) else ():
                        inside = (s >= least) & (s <= score)
                        if inside.any():
                            had[place] = best(ids[inside], s[inside], k_neg, had[place])
                out += [(me, akey, w[0], w[1], w[2], int(i), int(s)) for w in windows for i, s in zip(*had[w[0]])]
        return pd.DataFrame(out, columns=["id", "akey", "place", "positive_id", "positive_score", "negative_id", "negative_score"]).astype("int64")

    def at_shards(x: DataFrame) -> DataFrame:
        return x.withColumn("batch", F.pmod("akey", F.lit(batches))).withColumn("shard", _each(shards))

    near = at_shards(asked).groupBy("shard", "batch").cogroup(at_batches.groupBy("shard", "batch")).applyInPandas(
        find_positives, "id long, akey long, positive_id long, score long")
    place = F.row_number().over(Window.partitionBy("id", "akey").orderBy(F.col("score").desc(), "positive_id"))
    positives = near.withColumn("place", place).where(F.col("place") <= k_pos).groupBy("id", "akey").agg(
        F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "positive_id", "score")).alias("positives"))  # k_pos at most
    ready = scratch.table(asked.join(positives, ["id", "akey"]), "positives")
    found = at_shards(ready).groupBy("shard", "batch").cogroup(at_batches.groupBy("shard", "batch")).applyInPandas(
        find_negatives, "id long, akey long, place long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("id", "akey", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k_neg).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
