"""Operator 4, quality rules: a linear-chain CRF labels lines, the share of content words decides.

Workers turn each text into line features (numpy), the CRF is fitted on a bounded sample of labelled
documents, and Viterbi decoding labels every line of every document as content or boilerplate. Plain
base rules (too few words, too much repetition) reject first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, hash_sample

TRAIN_DOCS = 1000     # labelled documents per class that fit the CRF, by hash of the id (a bound of the fit only)
TRAIN_LINES = 64      # lines of one such document that enter the fit, from its start
MIN_WORDS = 10
MAX_REPEAT = 20       # percent of words in repeated 5-word windows
MIN_CONTENT = 0.5     # content words over all words of a kept document
N = 5
SYMBOLS = "#*$%&|<>"
CONTENT, BOILERPLATE = 1, 0

_WORD = re.compile(WORD)
# ratios of a line, cut at these bounds into one-hot features
_BOUNDS = np.array([0.02, 0.1, 0.25, 0.5, 0.8])
_RATIOS = ("alphabetic words", "upper-case words", "symbols", "repeated neighbours", "distinct words", "one-character words",
           "words with digits", "exclamation marks")
_EXTRA = 6 + 5  # length class, then flags
FEATURES = len(_RATIOS) * (len(_BOUNDS) + 1) + _EXTRA + 1


def repeated_words(words: list[str], n: int = N) -> int:
    """Words inside n-word windows that occur at least twice in the text, the first occurrence included."""
    if len(words) <= n:
        return 0
    ids: dict[str, int] = {}
    g = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) == len(words):
        return 0
    # ranks of 2-, 4- and then 5-word windows: equal rank means equal words
    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    two = rank(g[:-1], g[1:])
    four = rank(two[:-2], two[2:])
    five = rank(four[:-1], g[4:])
    again = np.bincount(five)[five] > 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[:len(again)] += again
    cover[n:n + len(again)] -= again
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _line_ratios(line: str, words: list[str]) -> list[float]:
    n = len(words)
    return [sum(map(str.isalpha, [w[:-1] if w[-1] in ".,;:?" and len(w) > 1 else w for w in words])) / n,
            sum(map(str.isupper, words)) / n,
            sum(map(line.count, SYMBOLS)) / len(line),
            sum(map(eq, words, words[1:])) / n,
            len(set(words)) / n,
            sum(1 for w in words if len(w) == 1) / n,
            sum(1 for w in words if not w.isalpha() and any(map(str.isdigit, w))) / n,
            line.count("!") / n]


def analyse(text: str | None) -> tuple[tuple[int, int, int, int, int], np.ndarray, np.ndarray]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), features per line, words per line)."""
    text = text or ""
    all_words: list[str] = []
    rows, flags, counts = [], [], []
    seen: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        dup = line in seen
        seen.add(line)
        dups += dup
        all_words += words
        rows.append(_line_ratios(line, words))
        k = min(5, len(words).bit_length() - 1)
        flags.append([k == j for j in range(6)] + [not counts, dup, line[-1] in ".!?", line[0].isupper(), len(words) > 1 and words[-1] == words[0]])
        counts.append(len(words))
    base = (len(all_words), sum(map(len, all_words)), sum(map(text.count, SYMBOLS)), dups, repeated_words(all_words))
    if not rows:
        return base, np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    bins = np.searchsorted(_BOUNDS, np.array(rows), side="right")
    onehot = (bins[:, :, None] == np.arange(len(_BOUNDS) + 1)).reshape(len(rows), -1)
    return base, np.hstack([onehot, np.array(flags), np.ones((len(rows), 1))]).astype(np.float32), np.array(counts)


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Line features (documents, lines, FEATURES) padded with 0, and the lengths."""
    n = np.array([len(s) for s in seqs])
    out = np.zeros((len(seqs), int(n.max(initial=0)), seqs[0].shape[1] if seqs else 2), dtype=np.float32)
    for i, s in enumerate(seqs):
        out[i, :len(s)] = s
    return out, n


class Crf:
    """Binary linear-chain CRF: line weights (features, 2), transitions (2, 2)."""

    def __init__(self, w: np.ndarray, trans: np.ndarray):
        self.w, self.trans = w, trans

    @classmethod
    def fit(cls, docs: list[np.ndarray], labels: list[int], rounds: int = 150, rate: float = 0.2, decay: float = 1e-3) -> "Crf":
        """Maximum likelihood by gradient steps (Adam); every line of a document carries the document's label.

        Both classes weigh the same. The labels are weak: single clean lines of bad documents are taken
        for boilerplate; the many lines of good documents outweigh them.
        """
        model = cls(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
        keep = [i for i, d in enumerate(docs) if len(d)]
        docs, y = [docs[i] for i in keep], np.array([labels[i] for i in keep])
        if not len(y) or len(set(y.tolist())) < 2:
            model.w[-1, CONTENT] = 1.0  # nothing to learn from: all lines are content
            return model
        x, n = _padded(docs)
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) / np.maximum(n, 1)
        live = np.arange(x.shape[1])[None, :] < n[:, None]
        target = np.zeros((*x.shape[:2], 2))
        target[np.arange(len(y)), :, y] = live
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (y, y), weight * (n - 1))
        m1, m2 = [np.zeros_like(model.w), np.zeros_like(model.trans)], [np.zeros_like(model.w), np.zeros_like(model.trans)]
        for step in range(1, rounds + 1):
            node, edge = model._marginals(x @ model.w, n, live, weight)
            gw = np.tensordot(x, (target - node) * weight[:, None, None], axes=([0, 1], [0, 1])) - decay * model.w
            gt = pairs - edge - decay * model.trans
            for j, (p, g) in enumerate(((model.w, gw), (model.trans, gt))):
                m1[j] = 0.9 * m1[j] + 0.1 * g
                m2[j] = 0.999 * m2[j] + 0.001 * g * g
                p += rate * (m1[j] / (1 - 0.9 ** step)) / (np.sqrt(m2[j] / (1 - 0.999 ** step)) + 1e-8)
        return model

    def _marginals(self, s: np.ndarray, n: np.ndarray, live: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over padded line scores: line marginals and the weighted sum of pair marginals."""
        t = s.shape[1]
        a = np.zeros_like(s)
        b = np.zeros_like(s)
        a[:, 0] = s[:, 0]
        for k in range(1, t):
            a[:, k] = np.where(live[:, k, None], s[:, k] + np.logaddexp.reduce(a[:, k - 1, :, None] + self.trans, axis=1), a[:, k - 1])
        for k in range(t - 2, -1, -1):
            nxt = np.logaddexp.reduce(self.trans[None] + (s[:, k + 1] + b[:, k + 1])[:, None, :], axis=2)
            b[:, k] = np.where(live[:, k + 1, None], nxt, 0)
        z = np.logaddexp.reduce(a[:, -1], axis=1)
        node = np.exp(a + b - z[:, None, None]) * live[:, :, None]
        edge = np.zeros((2, 2))
        for k in range(1, t):
            p = np.exp(a[:, k - 1, :, None] + self.trans + (s[:, k] + b[:, k])[:, None, :] - z[:, None, None])
            edge += np.einsum("d,dij->ij", weight * live[:, k], p)
        return node, edge

    def decode(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi labels of every line of every document."""
        out = []
        for x in docs:
            s = x @ self.w
            back = np.zeros((len(s), 2), dtype=np.int8)
            v0, v1 = (float(s[0, 0]), float(s[0, 1])) if len(s) else (0.0, 0.0)
            (t00, t01), (t10, t11) = self.trans.tolist()
            for k, (e0, e1) in enumerate(s[1:].tolist(), 1):
                a0, b0, a1, b1 = v0 + t00, v1 + t10, v0 + t01, v1 + t11
                back[k] = b0 > a0, b1 > a1
                v0, v1 = max(a0, b0) + e0, max(a1, b1) + e1
            y = np.zeros(len(s), dtype=np.int8)
            if len(s):
                y[-1] = v1 > v0
                for k in range(len(s) - 1, 0, -1):
                    y[k - 1] = back[k, y[k]]
            out.append(y)
        return out


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Crf:
    """Fit the CRF on at most TRAIN_DOCS labelled documents per class, in one task that holds their line
    features (some 8 MB); only the weights reach the driver."""
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("int").alias("y"))
    pick = hash_sample(one, "y", "__id", TRAIN_DOCS)
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("t")).join(F.broadcast(pick), "__id").select("y", "t")  # 2 * TRAIN_DOCS rows

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [analyse(t)[1][:TRAIN_LINES].astype(np.int8) for t in b["t"]]
            yield pd.DataFrame({"sample": 0, "y": b["y"], "x": [v.tobytes() for v in x]})

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["y", "x"])  # the same sums whatever order the rows come in
        model = Crf.fit([np.frombuffer(x, np.int8).reshape(-1, FEATURES).astype(np.float32) for x in sample["x"]], sample["y"].tolist())
        return pd.DataFrame({"w": [model.w.tolist()], "trans": [model.trans.tolist()]})

    got = rows.mapInPandas(features, "sample int, y int, x binary").groupBy("sample").applyInPandas(fit, "w array<array<double>>, trans array<array<double>>").collect()
    if not got:
        return Crf.fit([], [])
    return Crf(np.array(got[0]["w"]), np.array(got[0]["trans"]))


def judge(df: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept.

    Null and blank texts have no words and fail the base rules. Repeated rows and ids are judged row by
    row; a null id stays null; an empty table gives an empty result; extra columns play no part.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                done = [analyse(t) for t in part["t"]]
                y = model.decode([d[1] for d in done])
                out = pd.DataFrame([d[0] for d in done], columns=names)
                share = np.array([float(d[2] @ lab) / max(1, int(d[2].sum())) for d, lab in zip(done, y)])
                out["base_failed"] = (out.n_words < MIN_WORDS) | (100 * out.n_repeat_words > MAX_REPEAT * out.n_words)
                out["content_share"] = share
                out["kept"] = ~out.base_failed & (share >= MIN_CONTENT)
                out.insert(0, "k", part["k"].to_numpy())
                yield out

    kind = dict(df.dtypes)[id_col]
    schema = "k string, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, content_share double, kept boolean"
    rows = df.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).alias("t")).mapInPandas(run, schema)
    return rows.select(F.col("k").cast(kind).alias(id_col), *rows.columns[1:])


def keep(df: DataFrame, model: Crf, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text the rules keep, all columns unchanged: the columns stay Arrow
    arrays of which a mask keeps rows, so no value is converted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for t in b.column(text_col).to_pylist():
                (n, _, _, _, rep), x, counts = analyse(t)
                good.append(n >= MIN_WORDS and 100 * rep <= MAX_REPEAT * n and float(counts @ model.decode([x])[0]) >= MIN_CONTENT * n)
            yield b.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)
