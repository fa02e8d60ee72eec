"""Split reading, fragment exports and containers: order, bounds and whole contents at any size."""

import json
import os

import pytest
from pyspark.sql import functions as F

from runledger.sources import config_files as SC
from runledger.sources import containers, exports
from runledger.sources import logs as SL
from runledger.sources.lines import split_lines
from runledger.streaming import streams as SS


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 4 KB, as large ones are every 128 MB."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _write(spark, name, files):
    root = SL.scratch_path(spark, name).replace("file:", "")
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", newline="") as f:
            f.write(text)
    return root


def _log(n, bad=()):
    lines = []
    for i in range(n):
        lines.append("" if i % 97 == 5 else "{broken" if i in bad else json.dumps({"type": "result", "result": f"r{i} " + "x" * (i % 300)}))
    return "\n".join(lines) + "\n"


def test_split_files_keep_line_numbers_and_strictness(spark, small_splits):
    root = _write(spark, "split", {"long.jsonl": _log(3000), "late.jsonl": _log(2000, {1990}), "short.jsonl": _log(3), "empty.jsonl": ""})
    assert split_lines(spark, root).filter(F.col("file").endswith("long.jsonl")).select("block").distinct().count() > 50
    got = {(os.path.basename(r.file), r.line_no): r.result for r in SL.read_run_log(spark, root, "strict").collect()}
    want = {}
    for name, text in (("long.jsonl", _log(3000)), ("short.jsonl", _log(3))):
        want |= {(name, i): json.loads(x)["result"] for i, x in enumerate(text.split("\n")) if x.strip()}
    assert got == want  # the file with one bad line near its end is void
    perm = SL.read_run_log(spark, root, "permissive")
    assert [(os.path.basename(r.file), r.line_no) for r in perm.filter("corrupt").collect()] == [("late.jsonl", 1990)]
    last = {os.path.basename(r.file): r.line_no for r in SL.result_messages(SL.read_run_log(spark, root)).collect()}
    assert last == {"long.jsonl": 2999, "short.jsonl": 2}


def test_stream_of_split_files_equals_batch(spark, small_splits):
    root = _write(spark, "split-stream", {"a.jsonl": _log(800), "b.jsonl": _log(900, {3}), "c.jsonl": _log(10)})
    for mode in ("strict", "permissive"):
        out = SL.scratch_path(spark, "st01")
        SS.run_available_now(SS.stream_run_log(spark, root), out, "append", "st01", SS.message_batch(mode))
        cols = ["file", "line_no", "corrupt", "type", "result"]
        got = {tuple(r) for r in spark.read.parquet(out).select(*cols).collect()}
        assert got == {tuple(r) for r in SL.read_run_log(spark, root, mode).select(*cols).collect()}


def test_array_export_of_groups_small_and_large(spark):
    """One conversation far larger than a fragment, many small ones, one message with line breaks."""
    n = 200_000
    big = spark.range(n).select(F.lit("big").alias("g"), "id", F.to_json(F.struct("id", F.md5(F.col("id").cast("string")).alias("t"))).alias("m"))
    many = spark.range(500).select(F.concat(F.lit("s"), F.col("id") % 100).alias("g"), "id", F.to_json(F.struct("id")).alias("m"))
    odd = spark.createDataFrame([(None, 1, '{\n"id": 1}'), ("one", 7, '"x"'), ("nul", 1, None)], "g string, id long, m string")
    path = SL.scratch_path(spark, "arrays")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        SL.write_json_array(big.union(many).union(odd), ["g"], "id", "m", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    manifest = spark.read.parquet(path + "-manifest")
    assert manifest.filter("g = 'big'").count() > 1  # it spans fragments
    assert split_lines(spark, path).select("file").distinct().count() <= 8  # files follow tasks, not the 103 groups
    lines = exports.read_fragments(spark, path)
    texts = {}
    for r in lines.collect():
        texts.setdefault(r.g, {})[r.line_no] = r.line
    assert all(sorted(x) == list(range(len(x))) for x in texts.values())
    arrays = {g: json.loads("\n".join(x[i] for i in range(len(x)))) for g, x in texts.items()}
    assert [x["id"] for x in arrays["big"]] == list(range(n))
    assert {g: [x["id"] for x in a] for g, a in arrays.items() if g and g[0] == "s"} == {f"s{k}": list(range(k, 500, 100)) for k in range(100)}
    assert arrays[None] == [{"id": 1}] and arrays["one"] == ["x"] and "nul" not in arrays


def test_kv_export_of_a_whole_table(spark):
    df = spark.range(1000).select(F.concat(F.lit("K"), F.col("id") % 700).alias("key"), F.col("id").cast("string").alias("value"), "id")
    path = SL.scratch_path(spark, "kv-all")
    SC.write_kv(df, path, order_col="id")
    got = {r.key: r.value for r in SC.read_kv_export(spark, path).collect()}
    assert got == {f"K{i % 700}": str(i) for i in range(1000)}  # the later of a repeated key


def test_run_log_export_voids_runs_not_files(spark):
    rows = [("a", 1, '{"type": "result", "result": "x"}'), ("b", 1, '{"type": "result"'), ("b", 2, '{"type": "result", "result": "y"}'), ("c", 1, " ")]
    path = SL.scratch_path(spark, "log-export")
    SL.write_run_logs(spark.createDataFrame(rows, "run string, seq int, line string"), "run", ["seq"], "line", path)
    assert [(r.run, r.result) for r in SL.read_run_log_export(spark, path).collect()] == [("a", "x")]
    assert SL.read_run_log_export(spark, path, "permissive").count() == 3


def test_answers_in_parts(spark):
    """Parts of bounded size whose concatenation is the answer."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), "id", F.concat(F.col("id").cast("string"), F.lit("\n")).alias("t")).union(
        spark.createDataFrame([(2, 1, None), (2, 2, "tail")], "k int, id long, t string"))
    parts = SS.assemble_stream(df, ["k"], "id", "t", 1000).collect()
    assert max(len(p.answer) for p in parts) <= 1006
    whole = {k: "".join(p.answer for p in sorted(parts, key=lambda p: p.part) if p.k == k) for k in (1, 2)}
    assert whole == {1: "".join(f"{i}\n" for i in range(20_000)), 2: "tail"}
    assert sum(p.n_chunks for p in parts) == 20_002


def test_container_files_follow_buckets_and_lookups_open_few(spark):
    df = spark.range(3000).select(F.concat(F.lit("d/"), F.col("id").cast("string")).alias("name"),
                                  F.when(F.col("id") != 8, F.repeat(F.concat(F.col("id").cast("string"), F.lit("é\n")), 5)).alias("text"))
    path = SL.scratch_path(spark, "container")
    containers.write_container(df, path, bucket_bytes=8000)
    files = spark.read.parquet(path + "-index").select("file").distinct().count()
    assert 5 < files < 40
    wanted = spark.createDataFrame([("d/7",), ("d/8",), ("nope",)], "name string")
    at = containers.locate(spark, path, wanted)
    assert at.count() == 2 and at.select("file").distinct().count() <= 2
    opened = containers.read_container(spark, path, wanted)
    assert len(opened.inputFiles()) <= 2 + 4  # the files named by the index and those of the wanted rows
    assert {r.name: r.text for r in opened.collect()} == {"d/7": "7é\n" * 5, "d/8": "", "nope": ""}
    back = {r.name: r.text for r in containers.read_container(spark, path).collect()}
    assert back == {r.name: r.text for r in df.collect()}
    gone = containers.read_container(spark, path + "-never", wanted)
    assert {r.text for r in gone.collect()} == {""}
    containers.write_container(df.limit(0), path + "-none")
    assert containers.read_container(spark, path + "-none").count() == 0


def test_packed_logs_read_as_files_of_their_own(spark, small_splits):
    """300 logs in as many files as there are tasks, one of them longer than a split and one with a bad line."""
    logs = {f"run={i}/a.jsonl": _log(2000) if i == 7 else _log(6, {4} if i == 9 else ()) for i in range(300)}
    rows = [(name, k, x) for name, text in logs.items() for k, x in enumerate(text.rstrip("\n").split("\n"))]
    root, path = _write(spark, "plain", {k: v for k, v in logs.items() if int(k[4:].split("/")[0]) < 20}), SL.scratch_path(spark, "packs")
    SL.pack_run_logs(spark.createDataFrame(rows, "name string, at int, line string"), "name", ["at"], "line", path)
    packs = split_lines(spark, path).select("file", "block").distinct().collect()
    assert len({r.file for r in packs}) <= 8 and len(packs) > 50
    name = F.regexp_extract("file", r"(run=\d+/a\.jsonl)$", 1).alias("name")
    for mode in ("strict", "permissive"):
        got = {tuple(r) for r in SL.read_run_log(spark, path, mode, packed=True).select(name, "line_no", "corrupt", "result").collect()}
        want = {tuple(r) for r in SL.read_run_log(spark, root, mode).select(name, "line_no", "corrupt", "result").collect()}
        assert {r for r in got if int(r[0][4:].split("/")[0]) < 20} == want
        assert len({r[0] for r in got}) == (299 if mode == "strict" else 300)
        out = SL.scratch_path(spark, "st01p")
        SS.run_available_now(SS.stream_run_log(spark, path, packed=True), out, "append", "st01p", SS.message_batch(mode))
        assert {tuple(r) for r in spark.read.parquet(out).select(name, "line_no", "corrupt", "result").collect()} == got


def test_run_log_queries_write_few_files(spark, tmp_path):
    """Logs of 500 users, some rows without one: files follow the tasks, and rows without a user are kept."""
    from runledger.plans.queries import sources as Q
    ev = spark.range(2000).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
                                  F.when(F.col("id") % 500 > 0, F.col("id") % 500).alias("user_id"), F.lit("click").alias("event_type"),
                                  F.lit(2.5).alias("value"), F.lit('{"k": 1}').alias("props"))
    ev.write.parquet(f"{tmp_path}/events.parquet")
    path = Q._write_run_logs(spark, str(tmp_path))
    assert spark.read.text(path, recursiveFileLookup=True).select("_metadata.file_path").distinct().count() <= 8
    got = Q.q_run_log_strict(spark, str(tmp_path)).groupBy("user_id").agg(F.max("line_no").alias("last")).collect()
    assert {(r.user_id, r.last) for r in got} == {(i or None, 3) for i in range(500)}


def test_packed_lines_with_breaks_and_names_that_cannot_be_packed(spark):
    df = spark.createDataFrame([("a", 1, '{"type": "result",\t"result": "x"}\n{"type": "result"}'), ("b", 1, None)], "name string, at int, line string")
    path = SL.scratch_path(spark, "packs")
    SL.pack_run_logs(df, "name", ["at"], "line", path)
    assert [(r.file[-2:], r.line_no, r.result) for r in SL.read_run_log(spark, path, packed=True).orderBy("line_no").collect()] == [("/a", 0, "x"), ("/a", 1, None)]
    with pytest.raises(Exception, match="tab or a line break"):
        SL.pack_run_logs(df.withColumn("name", F.lit("a\tb")), "name", ["at"], "line", SL.scratch_path(spark, "packs"))
