"""Golden cases (survey 7.3 traps) and model checks of the Column functions."""

import random

import pytest
from pyspark.sql import functions as F

from runledger.functions import config as C
from runledger.functions import text as T
from runledger.operators import runs


FENCE_CASES = [
    '[{"a": 1}]',
    '```json\n{"a": 1}\n```',
    '```\n[1, 2]\n```',
    'Here you go:\n```json\n{"x": [1]}\n```\nthanks',
    'prose {"a": [1, 2]} more',
    'prose [1, {"a": 2}] end',
    'obj first {"a": 1} then [2]',
    'open [ no close {"k": 1}',
    'first\n```json\n{"one": 1}\n```\nsecond\n```json\n{"two": 2}\n```',
    'not json at all',
    '   \n  {"padded": true}  \n',
    '',
]


def _one(spark, col_fn, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col(df.columns[0]))).collect()]


def test_extract_json_cases(spark):
    got = dict(zip(FENCE_CASES, _one(spark, T.extract_json, FENCE_CASES)))
    for case, out in got.items():
        assert out == out.strip() and out in case
    cases = {"```json\n[1]\n```": "[1]", "x ```\n{}\n``` y": "{}", "pre [1, 2] post": "[1, 2]", 'a {"k": [1]} b': '{"k": [1]}',
             "  [ ": "[", "no json": "no json", "```\n[1]\n```\n```\n[2]\n```": "[1]"}
    assert _one(spark, T.extract_json, list(cases)) == list(cases.values())


def _rand_text(rng, n):
    alphabet = "ab é\n{}[]`json"
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_extract_json_finds_embedded_documents(spark):
    """A JSON document inside prose or a fence comes back as it was; any result is part of its text."""
    import json

    rng = random.Random(7)
    docs = [json.dumps(rng.choice([[i, "a"], {"k": [i]}, [{"x": i}], {"t": "é"}])) for i in range(100)]
    texts = [f"see: {d} done" for d in docs] + [f"intro\n```json\n{d}\n```\nend" for d in docs]
    assert _one(spark, T.extract_json, texts) == docs * 2
    noise = [_rand_text(rng, rng.randint(0, 60)) for _ in range(300)]
    for text, out in zip(noise, _one(spark, T.extract_json, noise)):
        assert out in text


@pytest.mark.parametrize("n", [500, 100, 60, 20])
def test_truncate_model(spark, n):
    rng = random.Random(n)
    vals = []
    for _ in range(300):
        k = rng.choice([n - 1, n, n + 1, n * 2, n * 5])
        vals.append("".join(rng.choice("abcdé \n") for _ in range(max(k, 0))))
    vals.append("\n" + "x" * (n * 2))  # a newline at position 0 does not count
    suffix = "... (truncated)"
    for v, out in zip(vals, _one(spark, lambda c: T.truncate_text(c, n), vals)):
        assert len(out) <= max(n, len(suffix))
        if len(v) <= n:
            assert out == v
            continue
        head, at = out.removesuffix(suffix), max(n - len(suffix), 0)
        assert out.endswith(suffix) and v.startswith(head)
        window = v[max(at - 50, 0):at]
        if "\n" in window.lstrip("\n") or ("\n" in window and at > 50):
            assert v[len(head)] == "\n" and "\n" not in v[len(head) + 1:at]
        elif len(head) < at:
            assert v[len(head)] in "\n " and at - len(head) <= 50


def test_head_tail_model(spark):
    rng = random.Random(3)
    vals = ["y" * k for k in (0, 10, 7999, 8000, 8001)] + ["".join(rng.choice("aé\n") for _ in range(rng.randint(7000, 20000)))
                                                          for _ in range(20)]
    marker = "\n\n[... CONTEXT SUMMARIZED FOR LENGTH ...]\n\n"
    for v, out in zip(vals, _one(spark, T.head_tail, vals)):
        if len(v) <= 8000:
            assert out == v
        else:
            assert len(out) == 8000 + len(marker) and out[4000:-4000] == marker
            assert v.startswith(out[:4000]) and v.endswith(out[-4000:])


def test_summarise_jsonl(spark):
    blob = '{"type":"assistant","message":{"content":[{"text":"hi"}]}}\n{"type":"result","result":"done"}'
    no_result = '{"type":"assistant","message":{"content":[]}}\n{"type":"result","result":""}'
    bad = '{"type":"result","result":"x"}\n{"type": broken'
    out = _one(spark, T.summarise_jsonl, [blob, no_result, bad, "plain text"])
    assert out == ["done", "[JSONL output with 2 messages]... (truncated)", "x", "plain text"]


def test_classify_label(spark):
    df = spark.createDataFrame([(" /bug please ",), ("0",), ("nothing",), ("/feature and /bug",)], "s string")
    got = [tuple(r) for r in df.select(T.classify_label("s").alias("c")).select("c.label", "c.error").collect()]
    assert got == [("/bug", None), (None, "No command selected: 0"), (None, "Invalid command selected: nothing"),
                   ("/feature", None)]


def test_sensitive_lists_differ(spark):
    df = spark.createDataFrame([("DB_CREDENTIAL",), ("API_TOKEN",), ("KEYBOARD",), ("HOST",)], "k string")
    got = df.select(*[C.is_sensitive("k", p).alias(p) for p in ("generic", "parameter", "display")]).collect()
    assert [tuple(r) for r in got] == [(True, False, False), (True, False, True), (True, True, True),
                                       (False, False, False)]


def test_categorise_first_hit_wins(spark):
    df = spark.createDataFrame([("DB_URL",), ("API_PORT",), ("S3_BUCKET",), ("LOG_LEVEL",), ("NAME",)], "k string")
    assert [r[0] for r in df.select(C.categorise("k")).collect()] == [
        "Database Configuration", "API Configuration", "AWS Configuration", "Development Configuration",
        "Other Configuration"]


def test_stable_bucket_follows_code(spark):
    # the code's base-36 rule (not the README example numbers)
    ids = ["abc12345", "def67890", "a-b_c!", "!!!"]
    df = spark.createDataFrame([(i,) for i in ids], "s string")
    got = [r[0] for r in df.select(runs.stable_bucket(F.col("s"))).collect()]
    assert got[0] == int("abc12345", 36) % 15 and got[1] == int("def67890", 36) % 15
    assert 9100 + got[0] == 9108 and 9100 + got[1] == 9112
    assert got[2] == int("abc", 36) % 15
    assert 0 <= got[3] < 15  # no alphanumerics: stable hash fallback


def test_retry_backoff(spark):
    df = spark.range(0, 8).withColumnRenamed("id", "r")
    got = df.select(runs.retry_delay(F.col("r")), runs.total_backoff(F.col("r"))).collect()
    delays = [0, 1, 3, 5, 7, 9, 11, 13]
    assert [r[0] for r in got] == delays
    assert [r[1] for r in got] == [sum(delays[1:i + 1]) for i in range(8)]


def test_key_path_round_trip_loses_slashes(spark):
    df = spark.createDataFrame([("DB_HOST",), ("A/B_C",)], "k string")
    back = [r[0] for r in df.select(C.path_to_key(C.key_to_path(F.col("k"), "/p"), "/p")).collect()]
    assert back == ["DB_HOST", "A_B_C"]  # a key containing '/' does not survive (documented)
