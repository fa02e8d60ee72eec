"""Reachability without the pairs (J-07) and levels of deep graphs (J-10): interval labels of a spanning forest.

Every node keeps one of its prerequisites as its parent. The Euler tour of that forest (a list of two
elements per node: its way in and its way out) is ranked by pointer jumping in about log2(2n) rounds of
equi joins over 2n rows, whatever the depth. The ranks give every node an interval that holds the
intervals of the nodes that depend on it, and its depth. What the forest leaves out is reached by hops.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.operators.runs import attach, ordered_positions
from runledger.session import broadcast_small, cut_lineage

BLOCK_NODES = 50_000  # nodes whose levels one task works out together
SIG_WORDS = 16     # 64-bit words of a node's signature
SIG_LEVELS = 32    # deeper nodes have no signature and are answered by the closure of the exits


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tour(tree: DataFrame, g: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Labels of a forest (graph..., node, parent; one parent per node) and the nodes that lead into a cycle.

    Labels: (graph..., node, low, high, depth): a node's subtree, itself included, is the nodes whose
    ``high`` is greater than its ``low`` and at most its ``high``; ``high`` runs from 1 to the graph's size.
    """
    g = list(g)
    e = cut_lineage(tree.select(*g, "node", "parent"))
    nodes = e.select(*g, "node").union(e.select(*g, "parent")).distinct()
    roots = nodes.join(e, [*g, "node"], "left_anti").select(*g, "node", F.lit(None).cast(e.schema["parent"].dataType).alias("parent"))
    kids = cut_lineage(ordered_positions(e.unionByName(roots), [*g, "parent"], ["node"]))
    first = kids.filter("position = 1 AND parent IS NOT NULL").select(*g, F.col("parent").alias("node"), F.col("node").alias("_child"))
    follows = kids.select(*g, "parent", (F.col("position") - 1).alias("position"), F.col("node").alias("_next"))
    base = attach(kids, follows, [*g, "parent", "position"]).join(first, [*g, "node"], "left")  # roots are siblings below no node
    # elements: way in (out = false) and way out of a node, with the element that follows
    ins = base.select(*g, "node", F.lit(False).alias("out"), F.coalesce("_child", "node").alias("to"), F.col("_child").isNull().alias("to_out"),
                      F.lit(1).cast("long").alias("n_in"), F.lit(1).cast("long").alias("up"))
    outs = base.select(*g, "node", F.lit(True).alias("out"), F.coalesce("_next", "parent").alias("to"), F.col("_next").isNull().alias("to_out"),
                       F.lit(0).cast("long").alias("n_in"), F.lit(-1).cast("long").alias("up"))
    at = cut_lineage(ins.unionByName(outs))
    for _ in range(max(1, at.count()).bit_length()):
        live = at.filter("to IS NOT NULL")
        ahead = at.select(*g, F.col("node").alias("to"), F.col("out").alias("to_out"), F.col("to").alias("_to"),
                          F.col("to_out").alias("_to_out"), F.col("n_in").alias("_n"), F.col("up").alias("_u"))
        moved = live.join(ahead, [*g, "to", "to_out"]).select(
            *g, "node", "out", F.col("_to").alias("to"), F.col("_to_out").alias("to_out"), (F.col("n_in") + F.col("_n")).alias("n_in"),
            (F.col("up") + F.col("_u")).alias("up"))
        at = cut_lineage(moved.unionByName(at.filter("to IS NULL")))
        if at.filter("to IS NOT NULL").isEmpty():
            break
    labels = at.filter("to IS NULL").groupBy(*g, "node").agg(
        F.max(F.when(F.col("out"), F.col("n_in"))).alias("low"), F.max(F.when(~F.col("out"), F.col("n_in"))).alias("high"),
        F.max(F.when(~F.col("out"), -F.col("up"))).alias("depth"))
    return cut_lineage(labels.filter("low IS NOT NULL AND high IS NOT NULL")), at.filter("to IS NOT NULL").select(*g, "node").distinct()


class ReachIndex(NamedTuple):
    """``labels`` (graph..., node, low, high, depth, exit, sig), ``hops`` (graph..., exit, at, to, sig), see :func:`reach_index`."""

    graph_cols: list[str]
    labels: DataFrame
    hops: DataFrame | None


ONE_GRAPH = "_graph"  # graph column of an index over a single, unnamed graph


def reach_index(edges: DataFrame, graph_cols: Sequence[str] = (), node: str = "node", dep: str = "depends_on") -> ReachIndex:
    """J-07: an index that answers "is p a prerequisite of n" in rows of the question.

    Forests need n labels and nothing else, at any depth. Edges that the spanning forest leaves out
    start at ``exit`` nodes; every node knows the nearest one at or above it, and ``hops`` holds where the
    edges of an exit lead and the nearest exit there. No pair is made beforehand: a question goes from exit
    to exit, and only where the signature (:func:`signatures`) of the node it comes to may hold what is asked for. Cycles
    are cut by leaving edges to the hops; a node on a cycle is a prerequisite of itself, as in the closure.
    """
    g = list(graph_cols)
    if not g:
        return reach_index(edges.withColumn(ONE_GRAPH, F.lit(0)), [ONE_GRAPH], node, dep)
    e = cut_lineage(edges.select(*g, F.col(node).alias("node"), F.col(dep).alias("prereq")).distinct())
    tree = e.groupBy(*g, "node").agg(F.min("prereq").alias("parent"))
    labels, stuck = tour(tree, g)
    cyclic = not stuck.isEmpty()
    if cyclic:  # every cycle has an edge to a node that is not smaller: those leave the forest
        tree = cut_lineage(tree.join(stuck.withColumn("_s", F.lit(True)), [*g, "node"], "left").filter(
            F.col("_s").isNull() | (F.col("node") > F.col("parent"))).drop("_s"))
        labels, _ = tour(tree, g)
    rest = cut_lineage(e.join(tree.withColumnRenamed("parent", "prereq"), [*g, "node", "prereq"], "left_anti"))
    if rest.isEmpty():
        return ReachIndex(g, labels.withColumn("exit", F.lit(None).cast(e.schema["node"].dataType)), None)
    # nodes without any tree edge get intervals of their own, beyond all others
    alone = e.select(*g, "node").union(e.select(*g, "prereq")).distinct().join(labels, [*g, "node"], "left_anti")
    top = labels.groupBy(*g).agg(F.max("high").alias("_top"))
    beyond = ordered_positions(alone, g, ["node"]).join(top, g, "left").withColumn("high", F.coalesce("_top", F.lit(0)) + F.col("position"))
    labels = cut_lineage(labels.unionByName(beyond.select(*g, "node", (F.col("high") - 1).alias("low"), "high", F.lit(0).cast("long").alias("depth"))))
    exits = cut_lineage(rest.select(*g, "node").distinct())
    # the nearest exit at or above a node, or its root: pointer jumping over parents
    at = labels.select(*g, "node").join(tree.withColumnRenamed("parent", "_up"), [*g, "node"], "left").join(
        exits.withColumn("_x", F.lit(True)), [*g, "node"], "left")
    at = cut_lineage(at.select(*g, "node", F.when(F.col("_x"), F.col("node")).otherwise(F.coalesce("_up", "node")).alias("to")))
    while True:
        nxt = cut_lineage(at.join(at.select(*g, F.col("node").alias("to"), F.col("to").alias("_to")), [*g, "to"])
                          .select(*g, "node", F.col("_to").alias("to"), (F.col("_to") != F.col("to")).alias("_moved")))
        at = nxt.drop("_moved")
        if nxt.filter("_moved").isEmpty():
            break
    near = at.join(exits.select(*g, F.col("node").alias("to"), F.lit(True).alias("_x")), [*g, "to"], "left").select(
        *g, "node", F.when(F.col("_x"), F.col("to")).alias("exit"))
    near = cut_lineage(near)
    labels = labels.join(near, [*g, "node"])
    levels = block_levels(labels.select(*g, "node"), e.withColumnRenamed("prereq", "dep"), g, labels=None if cyclic else labels)
    labels = cut_lineage(labels.join(signatures(e, cut_lineage(levels), g), [*g, "node"], "left"))
    # where the edges of an exit lead, the tree's too
    above = tree.select(*g, "node", F.col("parent").alias("prereq")).join(exits, [*g, "node"], "left_semi")
    lands = labels.select(*g, F.col("node").alias("prereq"), F.col("high").alias("at"), F.col("exit").alias("to"), "sig")
    hops = rest.unionByName(above).join(lands, [*g, "prereq"]).select(*g, F.col("node").alias("exit"), "at", "to", "sig")
    return ReachIndex(g, labels, cut_lineage(hops))


def _sig_bits(c: Column) -> list[Column]:
    """The two places of a node in a signature."""
    return [F.pmod(F.xxhash64(c, F.lit(k)), F.lit(64 * SIG_WORDS)).cast("int") for k in range(2)]


def _may_lead(sig: Column, prereq: Column) -> Column:
    """False only where ``prereq`` is no prerequisite of the node with this signature."""
    held = [F.getbit(F.get(sig, F.shiftright(b, 6)), b.bitwiseAND(F.lit(63))) == 1 for b in _sig_bits(prereq)]
    return sig.isNull() | (held[0] & held[1])


def signatures(e: DataFrame, levels: DataFrame, g: Sequence[str]) -> DataFrame:
    """(graph..., node, sig) of the nodes of the first levels: a bit set with two bits of each transitive
    prerequisite, of one size whatever their number. A level is made from its edges and the levels below."""
    g, words = list(g), [f"_w{i}" for i in range(SIG_WORDS)]
    first = levels.filter(F.col("level") <= SIG_LEVELS)
    up = cut_lineage(e.join(first, [*g, "node"]).repartitionByRange("level").sortWithinPartitions("level"))
    parts = [cut_lineage(first.filter("level = 1").select(*g, "node", *[F.lit(0).cast("long").alias(w) for w in words]))]
    low, high = _sig_bits(F.col("prereq"))

    def word(i: int) -> Column:
        own = [F.when(F.shiftright(b, 6) == i, F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)))).otherwise(0) for b in (low, high)]
        return F.bit_or(F.col(words[i]).bitwiseOR(own[0]).bitwiseOR(own[1])).alias(words[i])

    for k in range(2, (first.agg(F.max("level")).first()[0] or 1) + 1):
        below = _union(parts).withColumnRenamed("node", "prereq")
        made = up.filter(F.col("level") == k).join(below, [*g, "prereq"]).groupBy(*g, "node").agg(*[word(i) for i in range(SIG_WORDS)])
        parts.append(cut_lineage(made))
    return _union(parts).select(*g, "node", F.array(*words).alias("sig"))


def is_prerequisite(pairs: DataFrame, index: ReachIndex, node: str = "node", prereq: str = "prereq", out_col: str = "is_prereq") -> DataFrame:
    """J-07: ``pairs`` with whether ``prereq`` is a transitive prerequisite of ``node``; false where either
    is not in the graph. The answer takes rows in the number of pairs; where the graph is no forest, the
    few that signatures leave open go on by hops."""
    g = index.graph_cols
    if g == [ONE_GRAPH] and ONE_GRAPH not in pairs.columns:
        return is_prerequisite(pairs.withColumn(ONE_GRAPH, F.lit(0)), index, node, prereq, out_col).drop(ONE_GRAPH)
    asked = pairs.select(*g, F.col(node).alias("_n"), F.col(prereq).alias("_p")).distinct()
    sig = [] if index.hops is None else [F.col("sig").alias("_sig")]
    n = index.labels.select(*g, F.col("node").alias("_n"), F.col("high").alias("_at"), F.col("exit").alias("_exit"), *sig)
    p = index.labels.select(*g, F.col("node").alias("_p"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    known = asked.join(n, [*g, "_n"])
    if sig:
        known = known.filter(_may_lead(F.col("_sig"), F.col("_p"))).withColumn("_sig", F.col("_sig").isNotNull()).withColumnRenamed("_sig", "_signed")
    by_tree = (F.col("_n") != F.col("_p")) & (F.col("_at") > F.col("_low")) & (F.col("_at") <= F.col("_high"))
    known = known.join(p, [*g, "_p"]).withColumn("_hit", by_tree)
    if sig:
        known = cut_lineage(known)
    yes = known.filter("_hit").select(*g, "_n", "_p")
    if sig:
        yes = yes.union(_by_hops(known.filter("NOT _hit AND _exit IS NOT NULL").select(*g, "_n", "_p", "_low", "_high", "_exit", "_signed"), index)).distinct()
    yes = yes.withColumn("_yes", F.lit(True)).withColumnsRenamed({"_n": node, "_p": prereq})
    return pairs.join(yes, [*g, node, prereq], "left").withColumn(out_col, F.coalesce("_yes", F.lit(False))).select(*pairs.columns, out_col)


def _by_hops(open_: DataFrame, index: ReachIndex) -> DataFrame:
    """(graph..., _n, _p) of the open pairs (graph..., _n, _p, _low, _high, _exit, _signed) that hops from their exit answer.

    A round takes every pair of a signed node one hop on from the exits it has come to and drops ways
    whose signature does not hold the prerequisite, and pairs that are answered. A hop leads to a lower
    level, so there are at most SIG_LEVELS rounds. Deep nodes, and those on or behind a cycle, are not
    signed: theirs are answered by the closure of the exits."""
    g = index.graph_cols
    hops = index.hops.withColumnsRenamed({"exit": "_exit", "at": "_at", "to": "_to", "sig": "_sig"})
    pair, hit = [*g, "_n", "_p"], (F.col("_at") > F.col("_low")) & (F.col("_at") <= F.col("_high"))
    yes, deep, open_ = [open_.select(*pair).limit(0)], open_.filter("NOT _signed"), open_.filter("_signed").drop("_signed")
    while not open_.isEmpty():
        moved = broadcast_small(open_).join(hops, [*g, "_exit"]).withColumn("_hit", hit)
        moved = moved.filter(F.col("_hit") | (F.col("_to").isNotNull() & _may_lead(F.col("_sig"), F.col("_p"))))
        moved = cut_lineage(moved.select(*pair, "_low", "_high", F.col("_to").alias("_exit"), "_hit").distinct())
        found = cut_lineage(moved.filter("_hit").select(*pair).distinct())
        yes.append(found)
        open_ = cut_lineage(moved.filter("NOT _hit").drop("_hit").join(broadcast_small(found), pair, "left_anti"))
    if deep.isEmpty():
        return _union(yes)
    # all exits reachable from an exit, and where their edges lead
    from runledger.operators.graph import closure
    links = index.hops.filter("to IS NOT NULL").select(*g, F.col("exit").alias("node"), F.col("to").alias("depends_on")).distinct()
    ends = hops.select(*g, "_exit", "_at")
    if not links.isEmpty():
        via = closure(links, g).select(*g, F.col("node").alias("_exit"), F.col("prereq").alias("_via"))
        ends = ends.unionByName(via.join(ends.withColumnRenamed("_exit", "_via"), [*g, "_via"]).select(*g, "_exit", "_at"))
    yes.append(deep.join(cut_lineage(ends.distinct()), [*g, "_exit"]).filter(hit).select(*pair))
    return _union(yes)


def prerequisite_counts(index: ReachIndex) -> DataFrame:
    """J-07: (graph..., node, n_prereqs) of a forest, straight from the labels."""
    if index.hops is not None:
        raise ValueError("the graph is no forest: count the closure's pairs")
    return index.labels.select(*index.graph_cols, "node", F.col("depth").alias("n_prereqs"))


def block_levels(n: DataFrame, e: DataFrame, g: Sequence[str], block_nodes: int | None = None, labels: DataFrame | None = None) -> DataFrame:
    """J-10: (graph..., node, level) of the nodes that are ever ready, in any graph.

    Nodes are cut into blocks along the tour of a spanning forest, so that long ways stay within a block.
    A round works out, in one task per block, every level that follows from the levels known so far,
    and passes the new levels on to the other blocks; rounds follow the blocks that a way crosses, not
    its length. A block holds ``block_nodes`` nodes and the edges between them; edges from other blocks
    arrive as one count and one greatest level per node. ``labels``: the tour's, where it is at hand.
    """
    g, size = list(g), block_nodes or BLOCK_NODES
    if labels is None:
        labels, _ = tour(e.groupBy(*g, "node").agg(F.min("dep").alias("parent")), g)
    block = F.floor((F.col("high") - 1) / size).alias("block")
    known = n.join(labels.select(*g, "node", block), [*g, "node"], "left")
    lone = known.filter("block IS NULL").join(e, [*g, "node"], "left_anti").select(*g, "node", F.lit(1).alias("level"))
    state = known.filter("block IS NOT NULL").join(e.groupBy(*g, "node").agg(F.count(F.lit(1)).alias("n_open")), [*g, "node"], "left")
    state = cut_lineage(state.select(*g, "node", "block", F.coalesce("n_open", F.lit(0)).alias("n_open"), F.lit(0).alias("top")))
    at = state.select(*g, "node", "block")
    inner = cut_lineage(e.join(at, [*g, "node"]).join(at.withColumnsRenamed({"node": "dep", "block": "_b"}), [*g, "dep"])
                        .filter("block = _b").select(*g, "block", "node", "dep"))
    kind = state.schema["node"].dataType.simpleString()

    def levels(rows: pd.DataFrame) -> pd.DataFrame:
        """Rows: nodes of a block (edge 0) with the number of open prerequisites and the greatest known
        level, and the edges between them."""
        of = rows[rows["edge"] == 0]
        left, top = dict(zip(of["node"], of["n_open"])), dict(zip(of["node"], of["top"]))
        users: dict = {}
        for a, b in zip(rows.loc[rows["edge"] == 1, "node"], rows.loc[rows["edge"] == 1, "dep"]):
            if a in left and b in left:
                users.setdefault(b, []).append(a)
        ready, out = [x for x, k in left.items() if k == 0], {}
        while ready:
            x = ready.pop()
            out[x] = top[x] + 1
            for y in users.get(x, ()):
                left[y] -= 1
                top[y] = max(top[y], out[x])
                if left[y] == 0:
                    ready.append(y)
        got = pd.DataFrame({"node": list(out), "level": list(out.values())})
        for c in [*g, "block"]:
            got[c] = rows[c].iloc[0]
        return got[[*g, "block", "node", "level"]]

    def passed_on(state: DataFrame, new: DataFrame) -> DataFrame:
        """The nodes left, knowing the levels of ``new``, and whether they were told any."""
        told = e.join(new.select(*g, F.col("node").alias("dep"), F.col("level").alias("_l")), [*g, "dep"]).groupBy(*g, "node").agg(
            F.count(F.lit(1)).alias("_k"), F.max("_l").alias("_top"))
        left = state.join(new.select(*g, "node"), [*g, "node"], "left_anti").join(told, [*g, "node"], "left")
        return cut_lineage(left.select(*g, "node", "block", (F.col("n_open") - F.coalesce("_k", F.lit(0))).alias("n_open"),
                                       F.greatest("top", F.coalesce("_top", F.lit(0))).alias("top"), F.col("_k").isNotNull().alias("told")))

    schema = ", ".join([*(f"{c} {state.schema[c].dataType.simpleString()}" for c in g), "block long", f"node {kind}", "level int"])
    done = [cut_lineage(lone)]
    state = passed_on(state, done[0]).withColumn("told", F.lit(True))
    while True:
        nodes = state.select(*g, "block", "node", F.col("node").alias("dep"), F.lit(0).alias("edge"), "n_open", "top")
        ties = inner.select(*g, "block", "node", "dep", F.lit(1).alias("edge"), F.lit(0).cast("long").alias("n_open"), F.lit(0).alias("top"))
        rows = nodes.unionByName(ties).join(state.filter("told").select(*g, "block").distinct(), [*g, "block"], "left_semi")
        new = cut_lineage(rows.groupBy(*g, "block").applyInPandas(levels, schema))
        if new.isEmpty():
            return _union(done)
        done.append(new.select(*g, "node", "level"))
        state = passed_on(state, new)
