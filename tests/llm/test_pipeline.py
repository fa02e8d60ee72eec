"""The pipeline, stage by stage, against plain Python on a small corpus."""

import re
from collections import Counter

import corpus_pipeline
import pytest

from runledger.llm import mixing, packing, quality

from .conftest import documents, sentence
from .test_models import brute_base
from .test_native import brute_lines, size


def junk(i):
    return " ".join(w.upper() + "!!" for w in sentence(7000 + i, 60).split())


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    def vary(s, i):
        w = s.split()
        w[i % len(w)] = "changed"
        return " ".join(w)

    shared, copied = sentence(1, 60), [sentence(2 + i, 90) for i in range(5)]
    rows = [(i, sentence(100 + i, 40) + "\n" + sentence(400 + i, 30) + ("\n" + shared if i % 4 == 0 else ""), "en", f"s{i % 3}") for i in range(90)]
    rows += [(200 + i, "\n".join(copied), "en", "s0") for i in range(6)]                                  # exact copies
    rows += [(300 + i, vary(vary(sentence(9, 120), i), 60 + i).replace(" ", "\n", 1), "de", "s1") for i in range(8)]  # near copies
    rows += [(400 + i, junk(i) + "\n" + junk(50 + i), "en", "s2") for i in range(30)]
    rows += [(500, None, None, None), (501, "", "en", "s0"), (502, "word " * 40, "en", None), (503, sentence(503, 50), None, None)]
    root = tmp_path_factory.mktemp("sf")
    documents(spark, rows).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], 0 if 400 <= r[0] < 500 else 1, 0) for r in rows[::2]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), rows


def shingled(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_stages_against_brute_force(spark, corpus, tmp_path):
    root, rows = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, root)
        if name != "best_fit_packing":
            assert got.columns == docs.columns
        got.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs.collect()
    texts = {r[0]: r[1] for r in rows}

    # quality: base rules by brute force; junk goes, clean documents stay unchanged
    kept = {x.doc_id: x.text for x in out["quality_rules"]}
    for i, t in texts.items():
        n, _, _, _, rep = brute_base(t)
        failed = n < 10 or 100 * rep > 20 * n
        assert (i in kept) == (not failed and not 400 <= i < 500), i
    assert all(texts[i] == t for i, t in kept.items())

    # line dedup: documents stay, lines go as brute force says
    lines = {x.doc_id: x.text for x in out["line_dedup"]}
    gone = brute_lines(sorted(kept.items()))
    assert set(lines) == set(kept)
    count = lambda t: sum(1 for x in (t or "").split("\n") if x.strip())
    assert {i: count(kept[i]) - count(lines[i]) for i in kept} == {i: gone[i] for i in kept}

    # near duplicates: the smallest id of every component
    sets, parent = {i: shingled(t) for i, t in lines.items()}, {i: i for i in lines}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(lines)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    single = {x.doc_id: x for x in out["ngram_jaccard_join"]}
    assert set(single) == {i for i in ids if find(i) == i}

    # mixing: the words of every document are those the mix takes
    taken = {x.doc_id: x.taken for x in mixing.mix(spark.read.parquet(f"{tmp_path}/ngram_jaccard_join")).collect()}
    words = Counter()
    for x in out["source_mixing"]:
        words[x.doc_id] += size(x.text)
    assert dict(words) == {i: n for i, n in taken.items() if n}

    # packing: every token of every row, gapless, at most one capacity a sequence
    encode = packing.load_encoder(packing.tokenizer_path())
    assert Counter(x.doc_id for x in out["best_fit_packing"] if x.piece == 0) == Counter(x.doc_id for x in out["source_mixing"])
    assert sum(x.length for x in out["best_fit_packing"]) == sum(len(encode(x.text)) + 1 for x in out["source_mixing"])
    spots = {}
    for x in out["best_fit_packing"]:
        spots.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in spots.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.CAPACITY


def test_run_equals_the_stages_and_takes_an_empty_table(spark, corpus, tmp_path):
    root, _ = corpus
    got = corpus_pipeline.run(spark, root)
    assert got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and got.count() > 0
    spark.read.parquet(f"{root}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{root}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert isinstance(quality.Crf.fit([], []), quality.Crf)
