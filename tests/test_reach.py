"""Reachability index and block levels against plain Python on graphs of every shape."""

import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import graph as G
from runledger.operators import reach as R


def _closure(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    found = set()
    for a in out:
        todo, seen = list(out[a]), set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += out.get(x, ())
        found |= {(a, x) for x in seen}
    return found


def _levels(nodes, edges):
    need = {n: {b for a, b in edges if a == n} for n in nodes}
    level, k = {}, 0
    while True:
        k += 1
        new = [n for n in nodes if n not in level and all(level.get(b, k) < k for b in need[n])]
        if not new:
            return level
        level |= dict.fromkeys(new, k)


def _graphs():
    r = random.Random(4)
    ids = list(range(60))
    r.shuffle(ids)
    yield "forest", [(i, r.randrange(i)) for i in range(1, 60) if i % 20]
    yield "chain of shuffled ids", list(zip(ids[1:], ids[:-1]))
    yield "star", [(i, 0) for i in range(1, 50)]
    yield "dag", list({(i, r.randrange(i)) for i in range(1, 40) for _ in range(3)})
    yield "dag of shuffled ids", list({(ids[i], ids[r.randrange(i)]) for i in range(1, 40) for _ in range(2)})
    yield "cycles", [(0, 1), (1, 2), (2, 0), (3, 0), (4, 3), (5, 5), (6, 5), (7, 8), (8, 7), (9, 4), (9, 7), (10, 11)]
    yield "any", list({(r.randrange(25), r.randrange(25)) for _ in range(30)})


def _all_graphs(spark, only=None):
    rows = [(name, a, b) for name, edges in _graphs() for a, b in edges if only is None or name in only]
    return rows, spark.createDataFrame(rows, "g string, node long, depends_on long")


@pytest.mark.parametrize("only", [None, ("forest", "star", "chain of shuffled ids")], ids=["any", "forests"])
def test_every_pair_is_answered_as_by_the_closure(spark, only):
    rows, df = _all_graphs(spark, only)
    index = R.reach_index(df, ["g"])
    ids = spark.range(62)
    asked = df.select("g").distinct().join(ids.toDF("node")).join(ids.toDF("prereq"))
    got = {tuple(r)[:3] for r in R.is_prerequisite(asked, index).filter("is_prereq").select("g", "node", "prereq").collect()}
    want = {(name, a, b) for name, edges in _graphs() if only is None or name in only for a, b in _closure(edges)}
    assert got == want
    assert (index.hops is None) == (only is not None)
    if only:
        counts = {(r.g, r.node): r.n_prereqs for r in R.prerequisite_counts(index).collect()}
        assert counts == {(g, n): sum((x, y) == (g, n) for x, y, _ in want) for g, a, b in rows for n in (a, b)}


def test_several_graphs_and_text_nodes(spark):
    rows = [("g1", "b", "a"), ("g1", "c", "b"), ("g2", "b", "c"), ("g2", "d", "c"), ("g2", "d", "b")]
    df = spark.createDataFrame(rows, "g string, node string, depends_on string")
    asked = spark.createDataFrame([("g1", "c", "a"), ("g2", "c", "a"), ("g2", "d", "c"), ("g2", "b", "c"), ("g1", "a", "c"), ("g3", "c", "a")],
                                  "g string, node string, prereq string")
    got = [r.is_prereq for r in R.is_prerequisite(asked, R.reach_index(df, ["g"])).orderBy("g", "node", "prereq").collect()]
    assert got == [False, True, True, False, True, False]


def test_long_chain_is_answered_in_its_own_rows(spark):
    n = 100_000
    e = spark.range(1, n).select("id", (F.col("id") - 1).alias("up")).toDF("node", "depends_on")
    index = R.reach_index(e)
    asked = spark.range(n).select(F.col("id").alias("node"), F.pmod(F.xxhash64("id"), F.lit(n)).alias("prereq"))
    got = R.is_prerequisite(asked, index)
    assert got.filter(F.col("is_prereq") != (F.col("prereq") < F.col("node"))).count() == 0 and got.count() == n
    assert R.prerequisite_counts(index).filter("n_prereqs <> node").count() == 0


@pytest.mark.parametrize("size", [3, 50_000])
def test_block_levels_of_any_graph(spark, size, monkeypatch):
    """In every graph node 11 also waits for 10, which is missing, and 1000 for none."""
    monkeypatch.setattr(R, "BLOCK_NODES", size)
    all_nodes, all_edges, want = [], [], set()
    for name, edges in _graphs():
        nodes, edges = sorted({x for e in edges for x in e} - {10}) + [1000], edges + [(11, 10)]
        nodes += [11] if 11 not in nodes else []
        all_nodes += [(name, n) for n in nodes]
        all_edges += [(name, a, b) for a, b in edges]
        want |= {(name, n, k) for n, k in _levels(nodes, edges).items()}
    got = G.dag_levels(spark.createDataFrame(all_nodes, "g string, node long"), spark.createDataFrame(all_edges, "g string, node long, depends_on long"), ["g"])
    assert {(r.g, r.node, r.level) for r in got.collect() if r.level} == want
    assert got.count() == len(all_nodes)


def test_deep_ladder_takes_few_rounds(spark, monkeypatch):
    """Two rails with rungs, 10,000 steps: no node is free of a second prerequisite."""
    n, rounds = 10_000, []
    cut = R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: (rounds.append(1), cut(df))[1])
    i = spark.range(1, n)
    left = F.pmod(F.col("id") * 7919, F.lit(n)) * 2  # ids in no order of depth
    before = F.pmod((F.col("id") - 1) * 7919, F.lit(n)) * 2
    e = _pairs(i, left, before).union(_pairs(i, left + 1, before + 1)).union(_pairs(i, left + 1, left)).union(_pairs(i, left, before + 1))
    levels = G.dag_levels(spark.range(2 * n).toDF("node"), e.union(spark.createDataFrame([(1, 0)], "node long, depends_on long")))
    assert levels.agg(F.max("level"), F.count("level")).first() == (2 * n, 2 * n)
    assert len(rounds) < 50


def _pairs(i, a, b):
    return i.select(a.alias("node"), b.alias("depends_on"))


def test_two_prerequisites_are_answered_without_the_closure(spark, monkeypatch):
    """Nodes with edges to a half and a third: every node is an exit, and no pair is made beforehand."""
    monkeypatch.setattr(G, "closure", lambda *a, **k: pytest.fail("the closure was made"))
    edges = [(i, j) for i in range(1, 400) for j in {i // 2, i // 3}]
    index = R.reach_index(spark.createDataFrame(edges, "node long, depends_on long"))
    assert index.hops.count() <= 2 * len(edges)
    asked = spark.range(400).toDF("node").crossJoin(spark.range(0, 400, 3).toDF("prereq"))
    got = {tuple(r) for r in R.is_prerequisite(asked, index).filter("is_prereq").select("node", "prereq").collect()}
    assert got == {(a, b) for a, b in _closure(edges) if b % 3 == 0}
