"""Mixing, preference formatting and line dedup against plain Python, with odd rows."""

import re
from collections import Counter

import pytest

from runledger.llm import line_dedup, mixing, ngram_join, preference

from .conftest import documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(t):
    return len(WORD.findall(t or ""))


def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, list(names), 1.5 * sum(sizes.values())
    while free:
        unit = left / sum(w[s] for s in free)
        full = [s for s in free if w[s] * unit >= 2 * sizes[s]]
        if not full:
            return target | {s: w[s] * unit for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mix_meets_every_budget(spark, odd_rows):
    rows = odd_rows + [(1000 + i, sentence(i, 3 + i % 40), "en", ["a", "b", "c", "d", None][min(4, i % 7)]) for i in range(600)]
    rows += [(5000, "one two three", "en", "d")] * 90  # repeated rows
    df = documents(spark, rows).withColumnRenamed("lang", "size")
    got = mixing.mix(df).collect()
    assert Counter((x.doc_id, x["size"]) for x in got) == Counter((r[0], size(r[1])) for r in rows)
    by_source, sizes = Counter(), Counter()
    for r in rows:
        sizes[r[3] if len(r) > 2 else "s0"] += size(r[1])
    target = water_fill(sizes)
    goals = {(x.source_size, round(x.target, 6)) for x in got}
    assert goals == {(sizes[s], round(target[s], 6)) for s in sizes}
    for x in got:
        assert 0 <= x.taken <= 2 * x["size"]
        by_source[(x.source_size, round(x.target, 6))] += x.taken
    for (n, t), taken in by_source.items():
        assert t + 0.5 >= taken > t - 92  # repeated rows at a cut share it, rounded down
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_table_holds_the_words_taken(spark):
    rows = [(i, sentence(i, 5 + i % 30) + "\n end ", "en", "abc"[i % 3]) for i in range(200)]
    df = documents(spark, rows)
    taken = {x.doc_id: x.taken for x in mixing.mix(df).collect()}
    out = mixing.materialise(df)
    assert out.columns == df.columns
    words, texts = Counter(), {i: t for i, t, *_ in rows}
    for x in out.collect():
        words[x.doc_id] += size(x.text)
        assert texts[x.doc_id].startswith(x.text) and x.n_chars == len(x.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_preference_pairs(spark):
    rows = [(1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "a"), (1, "chosen", 2, "user", "go"), (1, "chosen", 3, "assistant", "good"),
            (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "a"), (1, "rejected", 2, "user", "go"), (1, "rejected", 3, "assistant", "bad"),
            (1, "rejected", 3, "assistant", "bad"),
            (2, "chosen", None, None, None), (2, "chosen", 0, "user", "x<|im_end|>"), (2, "rejected", 0, "user", "y"),
            (3, "chosen", 0, "user", "alone"), (None, "chosen", 0, "user", "n"), (4, "chosen", 0, "user", "same"), (4, "rejected", 0, "user", "same"),
            (5, "other", 0, "user", "z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "pair_id long, side string, turn long, role string, text string, part int")
    out = preference.preference_pairs(df)
    got = {(x.pair_id, x.part): x.text for x in preference.assemble(out).collect()}
    turn = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert got == {
        (1, "prompt"): turn("user", "hi") + turn("assistant", "a") + turn("user", "go"),
        (1, "chosen"): turn("assistant", "good"), (1, "rejected"): turn("assistant", "bad"),
        (2, "chosen"): turn("user", "") + turn("user", "x< |im_end|>"), (2, "rejected"): turn("user", "y"),
        (4, "prompt"): turn("user", "same")}
    assert {(x.pair_id, x.part) for x in out.collect() if x.trained} == {(1, "chosen"), (1, "rejected")}
    assert preference.preference_pairs(df.limit(0)).count() == 0


def brute_lines(rows, q=line_dedup.Q):
    """Documents' kept lines: exact components of line similarity, first line of the smallest id stays."""
    windows = re.compile(r"(?=(\S.{0,%d}))(?:[!-⿿]+|\S)" % (q - 1), re.S)
    occ, sets = [], {}
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            key = line.strip(" \t\r\x0b\x0c")
            if key:
                occ.append((d, p, key))
                sets.setdefault(key, frozenset(m.group(1) for m in windows.finditer(key)))
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    seen, gone = set(), Counter()
    for d, p, k in sorted(occ, key=lambda o: (o[0] is None, o[0] or 0, o[1])):
        gone[d] += find(k) in seen
        seen.add(find(k))
    return gone


def test_line_dedup_equals_brute_force(spark, odd_rows):
    def vary(s, i):
        w = s.split()
        w[i % len(w)] = "changed"
        return " ".join(w)

    shared = [sentence(900 + i, 30) for i in range(6)]
    rows = [(r[0], r[1]) for r in odd_rows if r[0] not in (4, None)]  # ids repeat nowhere here
    for i in range(120):
        rows.append((100 + i, "\n".join([sentence(i, 12), shared[i % 6], vary(shared[(i + 1) % 6], i), "", "All Rights  reserved." if i % 2 else " All Rights  reserved. "])))
    df = documents(spark, rows).withColumnRenamed("lang", "h")
    out = line_dedup.dedup_lines(df)
    want = brute_lines(rows)
    got = {x.doc_id: x for x in out.collect()}
    assert len(got) == len(rows)
    assert sum(abs(got[d]["__n_dropped"] - want[d]) for d in got) <= 0.02 * sum(want.values())  # recall of the bands
    for d, t in rows:
        x = got[d]
        if t is None:
            assert x.text is None and x["__n_lines"] == 0
        else:
            assert len(x.text.split("\n")) >= 1 and set(x.text.split("\n")) <= set(t.split("\n")) | {""}
            assert x.n_chars == len(x.text)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_of_repeated_and_missing_ids(spark, odd_rows):
    out = line_dedup.dedup_lines(documents(spark, odd_rows)).collect()
    assert len(out) == len(odd_rows)
    texts = Counter((x.doc_id, x.text) for x in out)
    first = next(r[1] for r in odd_rows if r[0] == 4)
    assert texts[(4, first)] == 2 and texts[(5, "")] == 1 and texts[(None, "some words without an id")] == 1


def all_windows(line, q=line_dedup.Q):
    return frozenset(line[i:i + q] for i in range(max(1, len(line) - q + 1)))


def whole_brute_lines(rows):
    """As brute_lines, from the windows at every character."""
    occ = [(d, p, line.strip(" \t\r\x0b\x0c")) for d, t in rows for p, line in enumerate(t.split("\n")) if line.strip(" \t\r\x0b\x0c")]
    sets = {k: all_windows(k) for _, _, k in occ}
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    seen, gone = set(), Counter()
    for d, _, k in sorted(occ):
        gone[d] += find(k) in seen
        seen.add(find(k))
    return gone


def test_line_dedup_reads_every_character(spark):
    thai = "ภาษาไทยเขียนติดกันโดยไม่มีช่องว่างระหว่างคำ"
    pairs = [("2024-05-17", "2024-05-18"), ("https://a.org/x", "https://b.org/y"), ("ORDER-000123", "ORDER-000124"),
             (thai, thai[:8] + "".join(reversed(thai[8:]))), ("𝒳𝒴𝒵" * 5 + "a", "𝒳𝒴𝒵" * 5 + "bcdefghijklm")]
    near = [("x" + sentence(70, 9) + " the end", sentence(70, 9) + " the end"), (thai * 2, "ก" + (thai * 2)[1:])]
    rows = [(10 * i + j, line) for i, pair in enumerate(pairs + near) for j, line in enumerate(pair)]
    want = whole_brute_lines(rows)
    assert sum(want.values()) == len(near) + 1  # the text twice is also near to itself once
    got = {x.doc_id: x for x in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert {d: x["__n_dropped"] for d, x in got.items()} == {d: want[d] for d, _ in rows}


def drifting(families=2, each=300, passages=90):
    """Lines of families in which every line changes two neighbouring words of an earlier one, and lines that share half their text."""
    import random
    r = random.Random(4)
    lines = []
    for f in range(families):
        family = [sentence(5000 + f, 24).split()]
        for i in range(each - 1):
            w = list(r.choice(family[-6:]))
            k = r.randrange(23)
            w[k:k + 2] = sentence(9000 + 1000 * f + i, 2).split()
            family.append(w)
        lines += [" ".join(w) for w in family]
    shared = sentence(77, 16)
    return lines + [f"{shared} {sentence(20000 + i, 8)}" for i in range(passages)]


@pytest.mark.parametrize("hot", [line_dedup.HOT, 20])
def test_line_dedup_follows_drifting_families(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = list(enumerate(drifting()))
    want = whole_brute_lines(rows)
    got = sum(x["__n_dropped"] for x in line_dedup.dedup_lines(documents(spark, rows)).collect())
    assert 0.99 * sum(want.values()) <= got <= sum(want.values())


def test_lines_and_copies_go_row_by_row(spark):
    s = [sentence(300 + i, 15) for i in range(12)]
    rows = [(1, s[0]), (7, "\n".join([s[1], s[0]])), (7, "\n".join([s[2], s[3]])), (None, "\n".join([s[4], s[0]])),
            (None, "\n".join([s[5], s[6]])), (None, s[7]), (None, s[7])]
    got = Counter((x.doc_id, x.text) for x in line_dedup.dedup_lines(documents(spark, rows)).collect())
    assert got == Counter([(1, s[0]), (7, s[1]), (7, rows[2][1]), (None, s[4]), (None, rows[4][1]), (None, s[7]), (None, "")])

    rows = [(3, s[0]), (7, s[0]), (7, s[8]), (9, s[9]), (9, s[9]), (None, s[0]), (None, s[10]), (None, s[10]), (None, s[11]), (None, None), (None, None)]
    got = Counter((x.doc_id, x.text) for x in ngram_join.keep_first(documents(spark, rows)).collect())
    assert got == Counter([(3, s[0]), (7, s[8]), (9, s[9]), (None, s[10]), (None, s[11]), (None, None), (None, None)])


@pytest.mark.parametrize("op", [mixing, preference, line_dedup])
def test_native_operators_use_no_python_workers(op):
    import inspect

    assert not re.search(r"InPandas|InArrow|pandas_udf|\budf\b|\.rdd\b", inspect.getsource(op))
