import math
import random
import zlib

import numpy as np
import pytest

from runledger.llm import packing, search, sharding

from .conftest import documents, sentence


def brute_topk(rows, k):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(256 * x) for x in v]
            best[i] = max(best.get(i, w), w)
    out = []
    for q, v in best.items():
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in best.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_equals_brute_force_with_ties_and_bad_vectors(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, -0.5, 0.25, 0.5]) for _ in range(6)]) for i in range(700)]
    rows += [(900, None), (901, [1.0, None, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6),
             (5, [0.5] * 6), (904, []), (905, [0.3, 0.7])]
    df = spark.createDataFrame([(*x, "z") for x in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(x) for x in search.top_k(df, df, 5).collect())
    assert got == brute_topk(rows, 5)


def test_topk_of_huge_components_and_of_an_empty_table(spark):
    rows = [(1, [2.0 ** 40]), (2, [2.0 ** 14]), (3, [-1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in search.top_k(df, df, 1).collect()) == brute_topk(rows, 1)
    assert search.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_block_bounds_prune_without_losing_results():
    r = np.random.default_rng(2)
    centres = r.integers(-200, 200, (20, 8))
    blocks = [(np.arange(64) + 64 * i, c + r.integers(-5, 5, (64, 8))) for i, c in enumerate(centres)]
    q = np.stack([b[1][0] for b in blocks])
    got, scored = search.block_topk(np.array([10 ** 6 + i for i in range(20)]), q, blocks, 5)
    ids, m = np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])
    for i in range(20):
        s = m @ q[i]
        want = [int(ids[j]) for j in np.lexsort((ids, -s))[:5]]
        assert [v for a, v, _ in got if a == 10 ** 6 + i] == want
    assert scored < 20 * len(blocks) / 2


def test_open_bins_best_fit_and_fullest_closes_first():
    b = packing.OpenBins(10, 2)
    assert b.place(6) == (0, 0) and b.place(7) == (1, 0)
    assert b.place(3) == (1, 7)          # the bin it leaves fullest
    assert b.place(9) == (2, 0)          # two open again
    assert b.place(8) == (3, 0)          # the fullest (9 of 10) closed
    assert b.place(1) == (3, 8) and b.place(4) == (0, 6)


def test_packing_round_trip(spark, odd_rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    rows = [r for r in odd_rows] + [(100 + i, sentence(i, 5 + 17 * i % 400)) for i in range(150)] + [(300, "a <|endoftext|> b"), (301, "\x85  x  \r\n\ty ")]
    df = documents(spark, rows).withColumnRenamed("lang", "length")
    got = packing.pack(df, with_ids=True, pieces_per_task=60).collect()
    want = {}
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.setdefault(r[0], []).append(ids)
    by_doc, by_seq = {}, {}
    for x in got:
        assert len(x.ids) == x.length <= 1024 and zlib.crc32(np.array(x.ids, "<u4").tobytes()) == x.ids_crc32
        by_doc.setdefault(x.doc_id, []).append(x)
        by_seq.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert {k: sum(p.length for p in v) for k, v in by_doc.items()} == {k: sum(map(len, v)) for k, v in want.items()}
    for k, v in by_doc.items():
        if len(want[k]) == 1:
            v.sort(key=lambda p: p.piece)
            assert [i for p in v for i in p.ids] == want[k][0]
            assert [p.start for p in v] == [sum(q.length for q in v[:j]) for j in range(len(v))]
            assert all(p.length == 1024 for p in v[1:])
    for spots in by_seq.values():
        at = 0
        for o, n in sorted(spots):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(x.length for x in got)
    assert len(by_seq) <= 1.02 * total / 1024 + 4  # a few bins stay open in each of the tasks
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [400, 5000])
def test_shards_keep_their_limit_and_split_only_where_needed(spark, odd_rows, limit):
    rows = odd_rows + [(1000 + i, sentence(i, 12)) for i in range(300)] + [(77, sentence(77, 20))] * 120
    df = documents(spark, rows).withColumnRenamed("lang", "bytes")
    out, directory = sharding.shard(df, limit)
    got = out.collect()
    assert len(got) == len(rows)
    assert sorted(len((r[1] or "").encode()) for r in rows) == sorted(x.bytes for x in got)
    sizes = {}
    for x in got:
        sizes[x.shard_id] = sizes.get(x.shard_id, 0) + x.bytes
    assert {x.shard_id: x.shard_bytes for x in directory.collect()} == sizes
    assert all(v <= limit or k.startswith("own/") for k, v in sizes.items())
    plain = {k: v for k, v in sizes.items() if set(k) <= set("01")}
    for k in plain:  # no two buddies could have stayed one bucket
        if k:
            parent = sum(v for s, v in sizes.items() if not s.startswith("own/") and s.split("/")[0].startswith(k[:-1]))
            assert parent > limit
    assert sharding.shard(df.limit(0), limit)[0].count() == 0
