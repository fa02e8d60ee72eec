"""Language identification, quality rules and extraction: exact recursions, held-out accuracy, odd rows."""

import itertools
import random
import re

import numpy as np
import pandas as pd

from runledger.llm import extraction, langid, ngram_join, quality

from .conftest import documents, sentence

SF = "/root/testdata/sf0.01"


def segmentations(word, vocab):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        head = word[:n]
        i = vocab.get(head, 0 if n == 1 else None)
        if i is not None:
            for rest in segmentations(word[n:], vocab):
                yield [i, *rest]


def test_forward_sum_equals_all_segmentations():
    pieces = ["", "▁", "▁a", "ab", "b", "a", "abc", "c", "▁ab"]
    vocab = {p: i for i, p in enumerate(pieces) if p}
    r = np.random.default_rng(1)
    probs = r.random((2, len(pieces)))
    probs /= probs.sum(axis=1, keepdims=True)
    words = ["a", "abc", "abcab", "zab", "é", "abc" * 12]
    got = langid.word_scores(words, probs, langid.Pieces(pieces))
    for w, row in zip(words[:-1], got):
        for k in range(2):
            total = sum(np.prod(probs[k][s]) for s in segmentations("▁" + w, vocab))
            assert abs(row[k] - np.log(total)) < 1e-9
    assert np.isfinite(got).all()  # long words are rescaled
    short = langid.expected_counts(["abc"], np.array([2.0]), probs[0], langid.Pieces(pieces))
    weights = [(np.prod(probs[0][s]), s) for s in segmentations("▁abc", vocab)]
    want = np.zeros(len(pieces))
    for p, s in weights:
        np.add.at(want, s, 2 * p / sum(w for w, _ in weights))
    assert np.allclose(short, want)
    long = langid.expected_counts(["abc" * 500, "b"], np.array([3.0, 0.0]), probs[0], langid.Pieces(pieces))
    assert np.isclose(sum(n * max(1, len(p)) for n, p in zip(long, pieces)), 3 * 1501)  # every character in one piece


def test_words_are_runs_of_letters():
    assert langid.letter_words("½ ² Ⅳ 12_3") == []
    assert langid.letter_words("Ab½cd été_x日本 ①ǅ") == ["ab", "cd", "été", "x日本", "ǆ"]


def test_vocabulary_is_whole():
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(langid.VOCABULARY))
    letters = {p for i in range(sp.get_piece_size()) for p in [sp.id_to_piece(i).lower()] if p.lstrip("▁").isalpha() and "▁" not in p[1:]}
    assert set(langid.vocabulary()) == {"", *letters} and max(map(len, letters)) == 16


def test_kept_rows_come_back_unchanged(spark):
    import datetime as dt

    good = "\n".join(sentence(i, 30) for i in range(4))
    rows = [(2 ** 53 + 3, good, 2 ** 53 + 1, {"a": [1, None]}, dt.datetime(2024, 1, 1), None), (None, good, None, None, None, 1.5),
            (2 ** 62 + 1, good, 2 ** 60 + 1, {}, None, None), (4, "short", 1, None, None, None), (5, None, 1, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, m map<string,array<int>>, at timestamp_ntz, x double")
    model = quality.Crf(np.zeros((quality.FEATURES, 2)) + [[0, 1]], np.zeros((2, 2)))  # everything is content
    got = quality.keep(df, model)
    assert got.schema == df.schema
    assert [tuple(r) for r in got.collect()] == rows[:3]


def test_langid_held_out_accuracy_and_odd_rows(spark, odd_rows):
    from runledger.llm import queries

    pred = queries.QUERIES["op3_langid"](spark, SF).toPandas()
    truth = pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "lang"]]
    both = pred.merge(truth, on="doc_id")
    held = both[both.held_out & both.lang.notna()]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    vocab = langid.vocabulary()
    df = documents(spark, odd_rows).withColumnRenamed("source", "lang_pred")
    langs, probs = langid.train(df, vocab)
    got = langid.predict(df, langs, probs, vocab).collect()
    assert len(got) == len(odd_rows) and {x.lang_pred for x in got if x.doc_id in (1, 2, 3)} == {"und"}
    assert all(0 <= x.score <= 1 for x in got) and {x.lang_pred for x in got if x.doc_id in (4, 6)} <= set(langs)
    empty = df.limit(0)
    langs, probs = langid.train(empty, vocab)
    assert langs == [] and {x.lang_pred for x in langid.predict(df, langs, probs, vocab).collect()} == {"und"}
    assert langid.predict(empty, langs, probs, vocab).count() == 0


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i:i + 5]), []).append(i)
    cover = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def test_base_counts_equal_brute_force():
    r = random.Random(3)
    texts = [None, "", " \n\x0b", "a b a b a b a b a b", "x\nx\n\nx", "日本 ## 語 x"]
    texts += [" ".join(r.choice("abc#|") for _ in range(r.randint(1, 60))).replace(" a b", "\na b") for _ in range(200)]
    for t in texts:
        assert quality.analyse(t)[0] == brute_base(t)


def test_viterbi_and_marginals_equal_enumeration():
    r = np.random.default_rng(5)
    m = quality.Crf(r.normal(size=(quality.FEATURES, 2)), r.normal(size=(2, 2)))
    x = r.integers(0, 2, (5, quality.FEATURES)).astype(np.float32)
    s = x @ m.w
    score = {y: sum(s[i, c] for i, c in enumerate(y)) + sum(m.trans[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=5)}
    assert tuple(m.decode([x])[0].tolist()) == max(score, key=score.get)
    node, edge = m._marginals(s[None], np.array([5]), np.ones((1, 5), bool), np.ones(1))
    z = sum(map(np.exp, score.values()))
    for i in range(5):
        assert abs(node[0, i, 1] - sum(np.exp(v) for y, v in score.items() if y[i]) / z) < 1e-9
    assert abs(edge[0, 1] - sum(np.exp(v) * sum((a, b) == (0, 1) for a, b in zip(y, y[1:])) for y, v in score.items()) / z) < 1e-9


def test_quality_separates_labelled_documents(spark, odd_rows):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs.where("doc_id % 2 = 0"), labels)
    out = quality.judge(docs.where("doc_id % 2 = 1"), model).toPandas().merge(labels.toPandas(), on="doc_id")
    good, bad = out[(out.quality == 1) & ~out.base_failed], out[out.quality == 0]
    assert good.kept.mean() > 0.97 and bad.kept.mean() < 0.1
    df = documents(spark, odd_rows).withColumnRenamed("lang", "kept")
    got = quality.judge(df, model).collect()
    assert len(got) == len(odd_rows)
    for x in got:
        if x.doc_id in (1, 2, 3, 7):
            assert x.base_failed and not x.kept
    none = quality.train(df, labels.limit(0))  # nothing to learn from: the base rules alone decide
    assert {x.doc_id: x.kept for x in quality.judge(df, none).collect()}[6]
    kept = quality.keep(df, model)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {x.doc_id for x in got if x.kept}
    assert quality.judge(df.limit(0), model).count() == 0


def test_lstm_gradients_are_right():
    m = extraction.BiLstm(3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    r = np.random.default_rng(4)
    x = r.normal(size=(2, 4, extraction.INPUT))
    live = np.array([[True] * 4, [True, True, False, False]])
    y, known = r.integers(0, 2, (2, 4)).astype(float), live.astype(float)

    def loss():
        s = m.scores(x, live)
        return float((known * (np.logaddexp(0, s) - y * s)).sum() / known.sum())

    g = m.gradients(x, live, y, known)
    for key, at in (("wf", (3, 5)), ("wb", (extraction.INPUT + 2, 40)), ("wf", (-1, 7)), ("out", (1,))):
        old = m.p[key][at]
        m.p[key][at] = old + 1e-3
        up = loss()
        m.p[key][at] = old - 1e-3
        down = loss()
        m.p[key][at] = old
        assert abs((up - down) / 2e-3 - g[key][at]) < 2e-4


def test_blocks_of_broken_markup():
    page = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><!-- <p>no</p> -->"
            "<p><b>One &amp; two<br>three <p>Four\n five</p><ul><li>a<li><a href='x>y'>b</a></ul>tail &lt;x&gt; <3 <br/> end")
    got = [(p[-1][0] if p else "", t) for p, t, _ in extraction.blocks(page)]
    assert got == [("title", "T"), ("p", "One & two three"), ("p", "Four five"), ("li", "a"), ("li", "b"), ("body", "tail <x> <3 end")]
    assert extraction.blocks("") == [] and extraction.blocks("<div") == [] and extraction.blocks("<script>never ends") == []


def test_raw_elements_that_close_themselves_and_long_blocks():
    def texts(page):
        return [t for _, t, _ in extraction.blocks(page)]

    assert texts('<p>one</p><svg class="x" /><p>two</p><svg><text>no</text></svg><p>three</p><iframe src="a?b=c"/><p>four') == ["one", "two", "three", "four"]
    assert texts("<p>one</p><svg class=x/>no</svg><p>two") == ["one", "two"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be<math/> so</p>") == ["Let x=1 be so"]
    assert texts("<p>a</p><object data=f><p>fallback</p></object><p>b") == ["a", "fallback", "b"]
    head = " ".join(f"w{i}" for i in range(30))
    one, two = (extraction.features([((), f"{head} {tail}", 0.0)]) for tail in ("alpha " * 40, "omega " * 40))
    assert extraction._slot("w", "alpha", extraction.WORDS) != extraction._slot("w", "omega", extraction.WORDS) and not np.array_equal(one, two)
    assert np.isclose(one[0, extraction.TAGS:extraction.TAGS + extraction.WORDS].sum(), 1)


def test_extraction_of_unseen_layouts_and_given_pages(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = extraction.train(pages, made=1500)
    r, right, total = random.Random(77), 0, 0
    for _ in range(150):
        page, truth = extraction.made_page(r)
        seq = extraction.blocks(page)
        y = extraction.label(model, [seq])[0]
        right += sum(bool(g) == (t in truth) for g, (_, t, _) in zip(y, seq))
        total += len(seq)
    assert right / total > 0.98
    out = {x.page_id: x for x in extraction.extract(pages, model).collect()}
    exact = 0
    for x in pages.collect():
        body = re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*?)</article>", x.html, re.S).group(1))
        exact += out[x.page_id].text == re.sub(r"\s+", " ", html.unescape(body)).strip()
        assert out[x.page_id].n_chars == len(out[x.page_id].text)
    assert exact >= 0.98 * len(out)
    odd = spark.createDataFrame([(1, None, None, 0), (2, "u", "", 0), (None, "u", "<article><p>x y</p>", 0), (2, "u", "", 0), (3, "u", "<article>" + "<p>word word. " * 5000, 0)],
                                "page_id long, url string, html string, text int")
    got = extraction.extract(odd, model).collect()
    assert len(got) == 5 and [x.text for x in got if x.page_id in (1, 2)] == ["", "", ""]
    assert extraction.extract(odd.limit(0), model).count() == 0


def test_ngram_components_with_odd_rows(spark, odd_rows):
    def near(seed, i):
        w = sentence(seed, 80).split()
        w[i % 80] = f"edit{i}"
        return " ".join(w)

    rows = [(r[0], r[1]) for r in odd_rows] + [(1000 + i, near(i % 4, i)) for i in range(80)]
    rows += [(2000 + i, sentence(50, 60) + " " + sentence(3000 + i, 25)) for i in range(60)]  # a passage that many share
    df = documents(spark, rows).withColumnRenamed("lang", "h")
    got = ngram_join.jaccard_components(df).collect()
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] == rows[j][0] and rows[i][0] is not None
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) or same_id and sets[i] == sets[j]:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    want = sorted((str(d), len(sets[i]), str(low.get(find(i)))) for i, (d, _) in enumerate(rows))
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == want
    assert ngram_join.jaccard_components(df.limit(0)).count() == 0
    kept = ngram_join.keep_first(df)
    assert kept.columns == df.columns
    assert {x.doc_id for x in kept.collect()} == {d for i, (d, _) in enumerate(rows) if not sets[i] or d is None or low[find(i)] == d}
