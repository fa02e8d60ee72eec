"""Operator 12, phrase collocations by multikey three-way quicksort of suffix pointers.

Word counts come first; words too rare for any candidate end the suffixes they stand in. Every suffix of
two or more words left (to the maximum depth) is routed by its leading word, that of a hot word by its
next words too, so all suffixes that share a prefix meet in one group. There the pointers are sorted by
three-way partitioning on one word at a time: the size of an equal partition is the count of its prefix,
and partitions below the least count are abandoned. All open partitions of a group are split together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import Scratch

ROUTE = 1 << 19        # suffixes of a group, about
HOT_WORDS = 1 << 16    # most words that are routed by their next words too
BITS = 26              # log2 of the bits of the table of frequent words (8 MB)
SLICE = 1 << 20        # words whose suffixes are counted together before they are sent
CHUNK = 1 << 20        # text bytes that are split into words together
# Bytes: A-Z to lower case, piece ends to \n, tab to space.
_MAP = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Ids(dict):
    """Numbers words in the order of their first use; 0 is no word, 1 a piece end."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_ids(texts: list[bytes], ids: _Ids) -> np.ndarray:
    """The words of all texts as numbers, with 1 at every piece and text end."""
    out, part, size = [], [], 0
    for i, t in enumerate(texts):
        part.append(t)
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            tokens = (b"\n".join(part) + b"\n").translate(_MAP).replace(b"\n", b" \n ").split(b" ")
            got = np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens))
            out.append(got[got > 0])
            part, size = [], 0
    return np.concatenate(out) if out else np.empty(0, np.int32)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Signed 64-bit hashes of (lang, word), none 0."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) or 1 for w in words], dtype=np.uint64).view(np.int64)


def suffixes(ids: np.ndarray, frequent: np.ndarray, depth: int, starts: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of at least two words (n x depth word numbers, 0 after the end) and their counts.

    A suffix starts at one of the first ``starts`` words (all, if None) and ends at a piece end, before a
    word that is not ``frequent``, or after ``depth`` words.
    """
    ok = np.concatenate([frequent[ids], np.zeros(depth, bool)])
    at = np.flatnonzero(ok[:len(ids)][:starts] & ok[1:len(ids) + 1][:starts])
    longer = np.concatenate([ids, np.zeros(depth, ids.dtype)])
    cols, live = [], np.ones(len(at), bool)
    for j in range(depth):
        live = live & ok[at + j]
        cols.append(np.where(live, longer[at + j], 0).astype(np.int64))
    bits = int(ids.max(initial=1)).bit_length()
    if bits * depth <= 63:
        key = np.zeros(len(at), np.int64)
        for c in cols:
            key = key << bits | c
        key, n = np.unique(key, return_counts=True)
        return np.stack([key >> bits * (depth - 1 - j) & (1 << bits) - 1 for j in range(depth)], axis=1), n
    return np.unique(np.stack(cols, axis=1), axis=0, return_counts=True)


def equal_partitions(words: np.ndarray, weight: np.ndarray, least: int, keep_below: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of suffix pointers: (pointer, prefix length, count) of every prefix of
    two or more words.

    ``words``: n x depth, 0 after a suffix's end; ``weight``: occurrences behind each pointer. Each pass
    splits every open partition by the word of its middle pointer at its depth into less, equal and
    greater; an equal partition goes one word deeper, and its weight is its prefix's count. Partitions of
    weight under ``least`` are abandoned, but for those that compare one of the first ``keep_below`` words.
    """
    n, depth = words.shape
    ptr, start, deep = np.arange(n), np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    found = []
    while len(ptr):
        size = np.diff(np.append(start, len(ptr)))
        seg = np.repeat(np.arange(len(start)), size)
        key = words[ptr, deep[seg]]
        pivot = words[ptr[start + size // 2], deep][seg]
        part = seg * 3 + (key >= pivot) + (key > pivot)
        order = np.argsort(part, kind="stable")
        ptr, part = ptr[order], part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        name = part[first]
        total = np.add.reduceat(weight[ptr], first)
        size = np.diff(np.append(first, len(ptr)))
        same, at = name % 3 == 1, deep[name // 3]
        word = words[ptr[first], at]
        new = at + same
        counted = same & (word != 0) & (new >= 2) & ((total >= least) | (new < keep_below + 1))
        found.append((ptr[first[counted]], new[counted], total[counted]))
        go = ((total >= least) | (new < keep_below)) & (~same | (word != 0) & (new < depth))
        alive = np.repeat(go, size)
        ptr, deep, size = ptr[alive], new[go], size[go]
        start = np.cumsum(size) - size
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


def routes(hashes: np.ndarray, hot: np.ndarray, n_routes: int) -> np.ndarray:
    """The group of each suffix: by its first word, and by the next word as long as all before are hot."""
    h = hashes.astype(np.uint64)
    r, on = h[:, 0].copy(), np.ones(len(h), bool)
    for j in range(1, h.shape[1]):
        on &= np.isin(hashes[:, j - 1], hot)
        r[on] = (r[on] ^ (h[on, j] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    r ^= r >> np.uint64(32)
    return (r % np.uint64(n_routes)).astype(np.int64)


def _by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if text:
            out.setdefault(lang, []).append(text)
    return out


def _phrase_key(words: Column) -> Column:
    return F.filter(words, lambda x: x != 0)


def phrase_counts(docs: DataFrame, scratch: Scratch, max_words: int = 3, least: int = 10, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (lang, word, h, f) of all words, and (p, f) of the phrases of 2 to ``max_words``
    words that occur at least ``least`` times, p being the hashes of their words (which hold the lang)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in _by_lang(b).items():
                ids = _Ids()
                n = np.bincount(word_ids(texts, ids), minlength=len(ids))[2:]
                words = list(ids)[2:]
                yield pa.record_batch([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()),
                                       pa.array(word_hashes(lang, words)), pa.array(n.astype(np.int64))], names=["lang", "word", "h", "f"])

    words = scratch.table(rows.mapInArrow(count, "lang string, word binary, h long, f long")
                          .groupBy("lang", "word", "h").agg(F.sum("f").alias("f")), "words")
    total = words.agg(F.sum("f")).first()[0] or 0
    n_routes = max(1, math.ceil(total / ROUTE))
    frequent = words.where(F.col("f") >= least)
    hot = np.array([r[0] for r in frequent.where(F.col("f") >= max(ROUTE // 2, total // HOT_WORDS)).select("h").collect()], np.int64)  # HOT_WORDS at most
    # bits of the frequent words' hashes: a fixed size; a rare word that shares a bit only travels in vain
    cells = frequent.select((F.shiftright("h", 6).bitwiseAND(F.lit((1 << BITS - 6) - 1))).alias("cell"),
                            F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    got = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << BITS - 6, np.int64)
    table[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    names = [f"w{j}" for j in range(max_words)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, texts in _by_lang(b).items():
                ids = _Ids()
                seq = word_ids(texts, ids)
                h = np.concatenate([[0, 0], word_hashes(lang, list(ids)[2:])]).astype(np.int64)
                bit = table[h >> 6 & (1 << BITS - 6) - 1] >> (h & 63) & 1
                known = bit.astype(bool) & (h != 0)
                for at in range(0, len(seq), SLICE):
                    codes, n = suffixes(seq[at:at + SLICE + max_words], known, max_words, SLICE)
                    w = h[codes]
                    yield pa.record_batch([pa.array(routes(w, hot, n_routes)), *(pa.array(np.ascontiguousarray(w[:, j])) for j in range(max_words)),
                                           pa.array(n.astype(np.int64))], names=["route", *names, "f"])

    columns = ", ".join(f"{x} long" for x in names)

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        w, f = group[names].to_numpy(np.int64), group["f"].to_numpy(np.int64)
        # a prefix of hot words only lies in several groups: none of its parts may be abandoned
        parted = np.isin(w[:, 0], hot) & np.isin(w[:, 1], hot)
        out = []
        for rows_, below in ((~parted, 0), (parted, max_words - 1)):
            at, length, total_ = equal_partitions(w[rows_], f[rows_], least, below)
            got_ = np.where(np.arange(max_words) < length[:, None], w[rows_][at], 0)
            out.append(pd.DataFrame(got_, columns=names).assign(f=total_))
        return pd.concat(out)

    sent = rows.mapInArrow(route, f"route long, {columns}, f long")
    counted = sent.groupBy("route").applyInPandas(sort, f"{columns}, f long")
    phrases = counted.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return words, scratch.table(phrases.select(_phrase_key(F.array(*names)).alias("p"), "f"), "phrases")


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, keep: int = 2000, inside: int = 50,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``keep`` strongest phrases of 2 to ``max_words`` words of every language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at spaces and
    tabs. a = f(phrase) >= ``least``; a cut after k words has score floor(10^6 a^2 / (l r)) with the counts
    l, r of its sides; the lowest-scoring cut counts, ties to the smallest k. Phrases inside a longer
    candidate with 100 f(longer) >= ``inside`` a are dropped. Returns lang, rank (from 1; by score, a, both
    falling, then phrase in byte order), phrase, a, l, r, n (words of the language), score. Null and empty
    texts hold no words, a null lang is ``und``, repeated rows count each, an empty table gives an empty
    result; extra columns play no part. Words are compared by 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    words, phrases = phrase_counts(docs, scratch, max_words, least, text_col, lang_col)
    frequent = words.where(F.col("f") >= least)
    every = phrases.unionByName(frequent.select(F.array("h").alias("p"), "f"))
    m = F.size("p")
    longer = phrases.where(m > 2).select(F.explode(F.expr(
        "flatten(transform(sequence(2, size(p) - 1), m -> transform(sequence(1, size(p) - m + 1), i -> slice(p, i, m))))")).alias("p"), "f")
    longer = longer.groupBy("p").agg(F.max("f").alias("most"))
    kept = phrases.join(longer, "p", "left").where(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("f"))).select("p", F.col("f").alias("a"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), m - 1)))
    cuts = cuts.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("x"), F.slice("p", F.col("k") + 1, m - F.col("k")).alias("y"))
    cuts = cuts.join(every.select(F.col("p").alias("x"), F.col("f").alias("l")), "x").join(every.select(F.col("p").alias("y"), F.col("f").alias("r")), "y")
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(1000000 as {wide}) * cast(a as {wide}) * cast(a as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    best = cuts.groupBy("p", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    spelled = (kept.select("p", F.posexplode("p").alias("at", "h")).join(frequent.select("h", "lang", "word"), "h")
               .groupBy("p").agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("w")))).alias("ws"))
               .select("p", "lang", F.array_join(F.col("ws.w"), " ").alias("phrase")))  # max_words at most
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), "phrase"))
    out = best.join(spelled, "p").withColumn("rank", rank.cast("long")).where(F.col("rank") <= keep)
    return out.join(sizes, "lang").select("lang", "rank", "phrase", "a", "b.l", "b.r", "n", "b.score")
