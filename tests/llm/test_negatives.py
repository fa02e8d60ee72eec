import math
import random

import numpy as np
import pytest

from runledger.llm import negatives as N


def brute(rows, anchors, k_pos=5, k_neg=5, low=80, high=100):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rows and anchors as (id, label, vector)."""
    def ok(x):
        return x[0] is not None and x[1] is not None and x[2] is not None and all(v is not None and math.isfinite(v) for v in x[2])

    def ints(x):
        return (x[0], x[1], tuple(max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * v))) for v in x[2]))

    rows = [ints(x) for x in rows if ok(x)]
    out = []
    for me, label, v in {ints(x) for x in anchors if ok(x)}:
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), i, other) for i, other, w in rows if i != me)
        for s, p, _ in [x for x in scored if x[2] == label][:k_pos]:
            near = [x for x in scored if x[2] != label and low * -s <= high * -x[0] <= high * -s][:k_neg]
            out += [(me, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(near)]
    return sorted(out)


def run(spark, rows, anchors, **kw):
    schema = "vec_id long, label int, embedding array<double>"
    df, a = spark.createDataFrame(rows, schema), spark.createDataFrame(anchors, schema)
    return sorted(tuple(r) for r in N.hard_negatives(df, a, **kw).collect())


def vectors(seed, n, dims=8, labels=4):
    r = random.Random(seed)
    centres = [[r.uniform(-0.5, 0.5) for _ in range(dims)] for _ in range(3)]
    return [(i, r.randrange(labels), [c + r.choice([-0.1, 0.0, 0.05]) for c in r.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("pack,shard,batch", [(N.PACK, N.SHARD, N.BATCH), (16, 60, 7)])
def test_equals_brute_force_in_any_blocks(spark, monkeypatch, pack, shard, batch):
    for name, value in (("PACK", pack), ("SHARD", shard), ("BATCH", batch)):
        monkeypatch.setattr(N, name, value)
    rows = vectors(1, 500)
    assert run(spark, rows, rows[::9]) == brute(rows, rows[::9])
    assert run(spark, rows, rows[::50], k_pos=3, k_neg=2, low=95, high=110) == brute(rows, rows[::50], 3, 2, 95, 110)


def test_odd_rows(spark):
    """Nulls anywhere, non-finite and missing components, repeated rows, ties, a label of one row, negative scores."""
    rows = vectors(2, 60, 4) + [(100, 1, None), (101, None, [1.0] * 4), (None, 1, [1.0] * 4), (102, 1, [1.0, None]), (103, 2, [float("nan")] * 4),
                                (104, 2, [float("-inf")] * 4), (105, 1, []), (106, 2, [0.5]), (7, 1, [0.5] * 4), (7, 1, [0.5] * 4),
                                (7, 2, [0.5] * 4), (8, 1, [0.5] * 4), (9, 99, [-1.0] * 4)]
    assert run(spark, rows, rows) == brute(rows, rows)
    assert run(spark, rows, []) == [] and run(spark, [], rows) == []
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS id", "2 AS shard", "'x' AS v")
    assert sorted(tuple(r) for r in N.hard_negatives(df, df.where("vec_id % 10 = 0")).collect()) == brute(rows, [x for x in rows if x[0] is not None and x[0] % 10 == 0])


def test_one_label_for_a_third_of_all_rows_and_text_labels(spark):
    rows = [(i, 0 if i % 3 else i, v) for i, _, v in vectors(4, 300)]
    assert run(spark, rows, rows[::30]) == brute(rows, rows[::30])
    named = [(i, f"label {k % 3}", v) for i, k, v in rows]
    schema = "vec_id long, label string, embedding array<double>"
    got = N.hard_negatives(spark.createDataFrame(named, schema), spark.createDataFrame(named[::40], schema))
    assert sorted(tuple(r) for r in got.collect()) == brute(named, named[::40])


def test_huge_components(spark):
    rows = [(i, i % 2, [2.0 ** (5 * i), -(3.0 ** i), 1.0]) for i in range(12)] + [(50, 0, [1e300, 1.0, -1e300])]
    assert run(spark, rows, rows) == brute(rows, rows)


@pytest.mark.parametrize("bits", [3, 9, 20, 31, 40, 62])
def test_packed_products_are_exact(bits):
    r = random.Random(bits)
    top = 2 ** bits
    m = np.array([[r.randint(-top, top) for _ in range(5)] for _ in range(40)], dtype=np.int64)
    a = [r.randint(-top, top) for _ in range(5)]
    p = N.Pack(np.arange(40), np.zeros(40), m, min(a), max(a))
    want = [max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, row)))) for row in m.tolist()]
    assert p.scores(a).tolist() == want
    assert p.scores([min(a)] * 5).tolist() == [max(-2 ** 63, min(2 ** 63 - 1, min(a) * sum(row))) for row in m.tolist()]
