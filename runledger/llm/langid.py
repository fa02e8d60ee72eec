"""Operator 3, language identification: unigram piece models summed over all segmentations.

Every language has probabilities of the pieces of a fixed public vocabulary. A word's likelihood is the
sum over all its segmentations into pieces (forward algorithm), a text's the product over its words.
Probabilities come from expectation maximisation over word counts of a bounded sample. numpy runs the
recursions for all distinct words of a batch at once; workers remember words they have scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, hash_sample

TRAIN_DOCS = 1500      # sample documents per language, by hash of the id (a bound of the fit only)
ROUNDS = 3             # EM rounds
SMOOTH = 0.05          # expected count added to every piece
CACHE_WORDS = 200_000  # remembered words per worker; a full cache starts anew
VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = "und"

_RUN = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SCALED = 30           # longer words are rescaled at every position


def vocabulary(path: str | None = None) -> list[str]:
    """Lower-case letter pieces of the public vocabulary, '▁' marking a word start; index 0 is any other character."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    found = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return ["", *sorted(p for p in found if p and p.lstrip("▁").isalpha() and p.rfind("▁") < 1)]


class Pieces:
    """Vocabulary lookup of substrings by rolling 64-bit hashes, one sorted table per length."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        self.tables = {}
        for n in sorted({len(p) for p in pieces if p}):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == n])
            codes = np.array([[ord(c) for c in pieces[i]] for i in ids], dtype=np.uint64)
            h = np.zeros(len(ids), dtype=np.uint64)
            for k in range(n):
                h = (h + codes[:, k]) * _BASE
            order = np.argsort(h)
            self.tables[n] = (h[order], ids[order])

    def find(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """{length: ids (words, starts)} for words of one length; -1 where no piece; single characters always have one."""
        out = {}
        h = np.zeros(codes.shape, dtype=np.uint64)
        for n in range(1, min(self.longest, codes.shape[1]) + 1):
            h = (h[:, :codes.shape[1] - n + 1] + codes[:, n - 1:]) * _BASE
            if n in self.tables:
                keys, ids = self.tables[n]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                got = np.where(keys[at] == h, ids[at], -1)
                out[n] = np.where(got < 0, 0, got) if n == 1 else got
        return out


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, character codes) of the words of each length, a word-start mark in front."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w) + 1, []).append(i)
    for n, idx in groups.items():
        step = max(1, 200_000 // n)
        for at in range(0, len(idx), step):
            part = idx[at:at + step]
            text = "".join("▁" + words[i] for i in part)
            yield np.array(part), np.frombuffer(text.encode("utf-32-le"), dtype="<u4").reshape(-1, n).astype(np.uint64)


def word_scores(words: list[str], probs: np.ndarray, pieces: Pieces) -> np.ndarray:
    """log P(word | language), (words, languages): the forward sum over all segmentations."""
    table = np.vstack([probs.T, np.zeros((1, probs.shape[0]))])  # the last row answers id -1
    out = np.zeros((len(words), probs.shape[0]))
    for idx, codes in _by_length(words):
        ids = pieces.find(codes)
        n = codes.shape[1]
        a = [np.ones((len(idx), probs.shape[0]))]
        scale = np.zeros((len(idx), probs.shape[0]))
        for j in range(1, n + 1):
            s = np.zeros_like(a[0])
            for k, got in ids.items():
                if k <= j:
                    s += a[-k] * table[got[:, j - k]]
            a.append(s)
            a = a[-pieces.longest:]
            if n > _SCALED:
                scale += np.log(s)
                a = [x / s for x in a]
        out[idx] = scale + np.log(a[-1])
    return out


def expected_counts(words: list[str], counts: np.ndarray, p: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected uses of every piece in the weighted words of one language (forward-backward)."""
    out = np.zeros(pieces.size)
    table = np.append(p, 0.0)
    for idx, codes in _by_length(words):
        ids = pieces.find(codes)
        n, c = codes.shape[1], counts[idx]
        # fall[j] is the log of the forward sum up to j; the backward sums are kept relative to it, so
        # that long words do not underflow
        fall, b = np.zeros((n + 1, len(idx))), np.zeros((n + 1, len(idx)))
        b[n] = 1
        for j in range(1, n + 1):
            total = np.zeros(len(idx))
            for k, got in ids.items():
                if k <= j:
                    total += np.exp(fall[j - k] - fall[j - 1]) * table[got[:, j - k]]
            fall[j] = fall[j - 1] + np.log(total)
        for j in range(n - 1, -1, -1):
            for k, got in ids.items():
                if j + k <= n:
                    b[j] += table[got[:, j]] * b[j + k] * np.exp(fall[j] - fall[j + k])
        for k, got in ids.items():
            for j in range(n - k + 1):
                use = table[got[:, j]] * b[j + k] * np.exp(fall[j] - fall[j + k]) * c
                hit = got[:, j] >= 0
                out += np.bincount(got[hit, j], weights=use[hit], minlength=pieces.size)
    return out


def letter_words(text: str) -> list[str]:
    runs = _RUN.findall(text.lower())
    # the pattern also takes numerals such as a half or a superscript two, which are no letters
    return runs if "".join(runs).isalpha() else [x for r in runs for x in "".join(c if c.isalpha() else " " for c in r).split()]


def train(df: DataFrame, vocab: list[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities (languages, pieces)) from at most TRAIN_DOCS rows per language.

    Rows with a null text or language take no part. Word counts are aggregated and stay in a table; a
    round returns only languages x pieces sums.
    """
    scratch = Scratch(df.sparkSession, "langid")
    rows = df.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).where("lang is not null and t is not null")
    pick = hash_sample(rows.select("id", "lang"), "lang", "id", TRAIN_DOCS).distinct()
    sample = rows.join(F.broadcast(pick), ["id", "lang"]).select("lang", "t")  # TRAIN_DOCS rows per language
    pieces = Pieces(vocab)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("lang"):
                c: Counter = Counter()
                for t in part["t"]:
                    c.update(letter_words(t))
                if c:
                    yield pd.DataFrame({"lang": lang, "w": list(c), "n": list(c.values())})

    counts = scratch.table(sample.mapInPandas(count, "lang string, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    at = {lang: i for i, lang in enumerate(langs)}
    probs = np.ones((len(langs), pieces.size)) * 0.01

    def step(probs: np.ndarray):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for lang, part in b.groupby("lang"):
                    e = expected_counts(part["w"].tolist(), part["n"].to_numpy(float), probs[at[lang]], pieces)
                    ids = np.flatnonzero(e)
                    if len(ids):
                        yield pd.DataFrame({"lang": lang, "piece": ids, "e": e[ids]})

        return counts.mapInPandas(run, "lang string, piece int, e double").groupBy("lang", "piece").agg(F.sum(F.round("e", 6)).alias("e"))

    for _ in range(ROUNDS if langs else 0):
        e = np.full((len(langs), pieces.size), SMOOTH)
        for r in step(probs).collect():
            e[at[r[0]], r[1]] += r[2]
        probs = e / e.sum(axis=1, keepdims=True)
    scratch.drop("words")
    return langs, probs


_CACHE: dict = {}


def predict(df: DataFrame, langs: list[str], probs: np.ndarray, vocab: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score per row: the language of the greatest likelihood of the whole text and its
    posterior under equal priors.

    Null text, text without a letter, and any text when nothing was learned: 'und' with score 0. Equal
    likelihoods go to the first language in order. Repeated rows and null ids are scored like any other;
    an empty table gives an empty result; extra columns play no part.
    """
    key = hash((tuple(langs), probs.tobytes()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if _CACHE.get("key") != key:
            _CACHE.clear()
            _CACHE.update(key=key, words={}, scores=np.zeros((0, len(langs))), pieces=Pieces(vocab))
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.iloc[lo:lo + 256]
                docs = [Counter(letter_words(t)) if t else {} for t in part["t"]]
                words: dict = _CACHE["words"]
                if len(words) > CACHE_WORDS:
                    words = _CACHE["words"] = {}
                    _CACHE["scores"] = np.zeros((0, len(langs)))
                fresh = sorted({w for d in docs for w in d if w not in words}) if langs else []
                if fresh:
                    old, store = len(words), _CACHE["scores"]
                    if old + len(fresh) > len(store):
                        store = _CACHE["scores"] = np.vstack([store[:old], np.zeros((old + 2 * len(fresh), len(langs)))])
                    store[old:old + len(fresh)] = word_scores(fresh, probs, _CACHE["pieces"])
                    words.update(zip(fresh, range(old, old + len(fresh))))
                scores, pred, conf = _CACHE["scores"], [], []
                for d in docs:
                    if not d or not langs:
                        pred.append(UNKNOWN)
                        conf.append(0.0)
                        continue
                    ll = np.fromiter(d.values(), float, len(d)) @ scores[np.fromiter((words[w] for w in d), np.int64, len(d))]
                    best = int(ll.argmax())
                    pred.append(langs[best])
                    conf.append(float(1 / np.exp(ll - ll[best]).sum()))
                yield pd.DataFrame({"k": part["k"], "lang_pred": pred, "score": conf})

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).alias("t")).mapInPandas(run, "k string, lang_pred string, score double")
    return rows.select(F.col("k").cast(kind).alias(id_col), "lang_pred", "score")
