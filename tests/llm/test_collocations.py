import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.llm import collocations as C
from runledger.llm.common import Scratch

from .conftest import documents


def brute(rows, max_words=3, least=10, keep=2000, inside=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = {}
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall(r"[^ \t]+", piece)
            c = f.setdefault(lang or "und", Counter())
            for m in range(1, max_words + 1):
                c.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: v for p, v in c.items() if len(p) > 1 and v >= least}
        gone = {p[i:i + m] for p, v in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                if p[i:i + m] in cand and 100 * v >= inside * cand[p[i:i + m]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n, -x[0]) for i, x in enumerate(sorted(rows_)[:keep])]
    return sorted(out)


def corpus(seed, n, vocab=40):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeÉß") for _ in range(r.randint(1, 3))) for _ in range(vocab)]
    out = []
    for i in range(n):
        t = []
        for _ in range(r.randint(0, 60)):
            t.append(words[min(int(r.expovariate(0.15)), vocab - 1)])
            if r.random() < 0.1:
                t.append("New York City" if r.random() < 0.7 else "new york")
            t.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]))
        out.append((i, "".join(t), r.choice(["en", "en", "en", "fr", None, "und"]), "s"))
    return out


@pytest.mark.parametrize("route,hot", [(C.ROUTE, C.HOT_WORDS), (200, 1 << 16), (50, 4)])
def test_equals_brute_force_however_suffixes_are_routed(spark, monkeypatch, route, hot):
    """One group, many groups with hot words routed by their next words, and few words that may be hot."""
    monkeypatch.setattr(C, "ROUTE", route)
    monkeypatch.setattr(C, "HOT_WORDS", hot)
    monkeypatch.setattr(C, "SLICE", 700)
    rows = corpus(3, 250)
    df = documents(spark, rows)
    assert sorted(tuple(r) for r in C.collocations(df).collect()) == brute(rows)


def test_longer_phrases_and_other_bounds(spark, monkeypatch):
    monkeypatch.setattr(C, "ROUTE", 100)
    rows = corpus(5, 120, 12)
    got = C.collocations(documents(spark, rows), max_words=5, least=4, keep=7, inside=80).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, 4, 7, 80)


def test_odd_rows(spark, odd_rows):
    """Nulls, blank, repeated and very long texts; a null lang and the lang ``und`` are one; clashing extra columns."""
    long_line = " ".join(["buffalo"] * 5000)
    rows = [(*r[:2], *(r[2:] or ("en", "s"))) for r in odd_rows] * 12 + [(90, long_line, None, "s"), (91, "\x00a \x1cb c " * 30, "und", "s")]
    df = documents(spark, rows).withColumnsRenamed({"source": "h", "n_chars": "word"}).withColumn("f", F.lit(1))
    got = C.collocations(df).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
    assert C.collocations(documents(spark, [])).count() == 0
    assert C.collocations(documents(spark, [(1, None, None, None), (2, " .,", "en", "s")])).count() == 0


def test_scores_beyond_64_bits(spark):
    """The products of counts are exact: a square times a million passes 2^63 here."""
    a = 3_100_000
    rows = [(1, "p q " * a, "en", "s")]
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in C.collocations(documents(spark, rows)).collect()}
    assert 10 ** 6 * (a - 1) ** 2 > 2 ** 63
    assert 10 ** 6 * (a - 1) // a == 10 ** 6 * (a - 1) ** 2 // a ** 2 == 999_999  # both cuts tie: the first counts
    assert got["p q p"] == (a - 1, a, a - 1, 999_999)


def test_partition_sizes_are_counts():
    r = np.random.default_rng(1)
    words = r.integers(1, 6, (3000, 3))
    words[r.random(3000) < 0.2, 2] = 0
    weight = r.integers(1, 4, 3000)
    want = Counter()
    for w, n in zip(words.tolist(), weight.tolist()):
        for m in (2, 3):
            if w[m - 1]:
                want[tuple(w[:m])] += n
    at, length, total = C.equal_partitions(words, weight, 30)
    got = {tuple(words[i, :m].tolist()): t for i, m, t in zip(at, length, total.tolist())}
    assert got == {p: n for p, n in want.items() if n >= 30}
    at, length, total = C.equal_partitions(words, weight, 30, 2)  # pairs are kept at any size
    got = {tuple(words[i, :m].tolist()): t for i, m, t in zip(at, length, total.tolist())}
    assert got == {p: n for p, n in want.items() if n >= 30 or len(p) == 2}
    assert len(C.equal_partitions(words[:0], weight[:0], 1)[0]) == 0


def test_hot_leading_words_are_split(spark, monkeypatch):
    """A word that leads a third of all suffixes fills no single group."""
    monkeypatch.setattr(C, "ROUTE", 300)
    h = C.word_hashes("en", [b"the", *(b"w%d" % i for i in range(500))])
    w = np.stack([np.full(500, h[0]), h[1:], np.roll(h[1:], 1)], axis=1)
    r = C.routes(w, h[:1], 40)
    assert np.bincount(r, minlength=40).max() < 40
    assert len(set(C.routes(w, h[:0], 40).tolist())) == 1
    words, phrases = C.phrase_counts(documents(spark, corpus(1, 50)), Scratch(spark, "t"))
    assert phrases.where("f < 10").count() == 0 and words.where("f < 1").count() == 0
