"""Operator 5, best-fit packing: bounded-space online best fit over token pieces.

Tasks tokenize whole texts and emit piece rows without ids (tens of bytes each); packing tasks then
stream those rows through a fixed number of open bins, kept in a bitset keyed by free space. When no
open bin fits and all are taken, the fullest closes.
"""

from __future__ import annotations

import base64
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

CAPACITY = 1024
END_ID = 2           # closes every document
OPEN_BINS = 4096     # open bins of one packing task
PIECES_PER_TASK = 1_000_000  # sizes the number of packing tasks; drops nothing
TOKENIZER = "byte_bpe_50k.json"


class OpenBins:
    """Bins with room, by free space: ``bits`` has bit f set when some open bin has f tokens free."""

    def __init__(self, capacity: int = CAPACITY, limit: int = OPEN_BINS):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.open, self.made = 0, 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece: the open bin that it leaves fullest, else a new one."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            b, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
            self.open += 1
        return b, self.capacity - free


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_encoder(path: str):
    """Text to ids exactly as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.

    A rank file beside the JSON holds the same vocabulary for tiktoken, which gives the same ids about
    five times as fast; texts that hold one of the JSON's added tokens, and all texts where there is no
    rank file, go through the JSON itself.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda text: exact.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(os.path.basename(ranks), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    added = [t.content for t in exact.get_added_tokens_decoder().values()]
    return lambda text: exact.encode(text, add_special_tokens=False).ids if any(x in text for x in added) else fast(text)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities at the end, the odd rest first."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token pieces of every row: id, piece, start, length, ids_crc32 and, if asked for, ids."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch["k"].tolist(), batch["t"].tolist()):
                ids = array("I", encode(text))
                ids.append(end_id)
                raw = memoryview(ids.tobytes())  # little-endian unsigned 32-bit
                for j, (s, n) in enumerate(cut(len(ids), capacity)):
                    part = raw[4 * s:4 * (s + n)]
                    out.append((key, j, s, n, zlib.crc32(part), *([list(ids[s:s + n])] if with_ids else [])))
                if len(out) >= 20000:
                    yield pd.DataFrame(out, columns=cols)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=cols)

    cols = ["k", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = "k string, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    rows = df.select(F.col(id_col).cast("string").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = rows.mapInPandas(run, schema)
    return out.select(F.col("k").cast(kind).alias(id_col), *cols[1:])


def pack(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS, with_ids: bool = False,
         pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece: id, piece, start, length, ids_crc32, [ids,] sequence_id, offset. Sequences are
    gapless from offset 0 and only documents longer than ``capacity`` are cut.
    Each packing task gets a random-like share of the pieces (all of them up to ``pieces_per_task``),
    places them in runs with the long pieces of a run first, and ends with at most ``open_bins`` unfilled
    bins, of which best fit leaves few with much room.

    Null text is empty, so the document is its end token; null ids and repeated rows are packed row by
    row; an empty table gives an empty result; extra columns play no part.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "pack")
    p = scratch.table(pieces(df, path or tokenizer_path(), id_col, text_col, capacity, end_id, with_ids), "pieces")
    tasks = max(1, math.ceil(p.count() / pieces_per_task))
    lanes = p.repartition(tasks).sortWithinPartitions(F.xxhash64(id_col, "piece", "length", "ids_crc32"), id_col, "piece", "length", "ids_crc32")
    lanes = lanes.withColumn("lane", F.spark_partition_id())
    types = dict(p.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenBins(capacity, open_bins)
        for batch in batches:
            for at in range(0, len(batch), 2 * open_bins):  # a run: long pieces first, short ones fill up
                part = batch.iloc[at:at + 2 * open_bins].sort_values("length", ascending=False, kind="stable")
                spots = [bins.place(n) for n in part["length"].tolist()]
                lane = int(part.pop("lane").iloc[0]) << 40
                yield part.assign(sequence_id=[lane + b for b, _ in spots], offset=[o for _, o in spots])

    schema = ", ".join(f"`{c}` {types[c]}" for c in p.columns) + ", sequence_id long, offset long"
    return lanes.mapInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from ``pack(..., with_ids=True)``: sequence_id, ids (at most one capacity each)."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
