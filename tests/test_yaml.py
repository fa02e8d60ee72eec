"""YAML documents read by the fold, and those it refuses."""

import json

import pytest
from pyspark.sql import functions as F

from runledger.sources import config_files as SC
from runledger.sources.logs import scratch_path
from runledger.sources.yaml_fold import parsed_lines, yaml_json

READ = [
    ("a:\n  b:\n    c: 1\n  d: x\ne: 2", {"a": {"b": {"c": 1}, "d": "x"}, "e": 2}),
    ("l: [1, 2]\nm: {x: 1, y: [a b, 'c,d', \"e]\"]}", {"l": [1, 2], "m": {"x": 1, "y": ["a b", "c,d", "e]"]}}),
    ("t: |\n  line one\n    more: deep\n\n  # no comment\nu: >-\n  folded\n  text\n\n  next\nv: end", {"t": "line one\n  more: deep\n\n# no comment\n", "u": "folded text\nnext", "v": "end"}),
    ("- a\n- - b\n  - c\n-\n  - d\n- k: 1\n  m: 2\n- k: 3", ["a", ["b", "c"], ["d"], {"k": 1, "m": 2}, {"k": 3}]),
    ("servers:\n- host: a\n  ports:\n  - 80\n  - 81\n- host: b\n  ports: []\nlast: {}", {"servers": [{"host": "a", "ports": [80, 81]}, {"host": "b", "ports": []}], "last": {}}),
    ("---\n# head\nn: ~\ne:\nf: 'it''s'\ng: \"tab\\t\\u00e9\"  # tail\nh: a#b\ni: x # y\nj: http://h:80/p\n", {"n": None, "e": None, "f": "it's", "g": "tab\té", "h": "a#b", "i": "x", "j": "http://h:80/p"}),
    ("yes: no\nb1: On\nb2: FALSE\ni: -12\np: +7\nf1: 1.50\nf2: .5\nf3: 2.\nf4: 1.0e+3\ns1: 1e5\ns2: 2024-01-02\ns3: 1.2.3\ns4: nope\ns5: -x",
     {"yes": False, "b1": True, "b2": False, "i": -12, "p": 7, "f1": 1.5, "f2": 0.5, "f3": 2.0, "f4": 1000.0, "s1": "1e5", "s2": "2024-01-02", "s3": "1.2.3", "s4": "nope", "s5": "-x"}),
    ("a:\r\n  b: 1\r\nc: 2\r\n", {"a": {"b": 1}, "c": 2}),
    ("\"quoted key\": 1\n'other: key': 2\na b c: 3", {"quoted key": 1, "other: key": 2, "a b c": 3}),
    ("x:\n  - 1\n\n  # between\n  - 2\ny: {a: , b: 1}" .replace("a: , ", ""), {"x": [1, 2], "y": {"b": 1}}),
    ("k: |\n\n  after blank\nz: 1", {"k": "\nafter blank\n", "z": 1}),
    ("# nothing\n\n", {}),
    ("deep:\n  - - - x\n  - y:\n      - z: {q: [[1], []]}", {"deep": [[["x"]], {"y": [{"z": {"q": [[1], []]}}]}]}),
]

REFUSED = ["a: &x 1\nb: *x", "a: !!int 3", "<<: {b: 1}", "? a\n: b", "a: 1\n  b: 2", "a:\n  b: 1\n c: 2", "a: [1,\n  2]", "a: 'open\n  end'", "a: one\n  two", "a: 0x1F", "a: 017",
           "a: 1_000", "a: 12:30:45", "a: .inf", "a:\n\tb: 1", "a: 1\n---\nb: 2", "a: b: c", "a: \"\\x41\"", "a: |2\n   x", "a: |+\n  x\n\n", "a: >\n  x\n    y", "- 1\na: 2", "a: [1, 2,]", "a: {x}",
           "a: [b: 1]", "a: @x", "a: `x`", "%YAML 1.1\na: 1", "a: - b", "just text\nmore text", "a: ]"]


def test_documents_are_read_whole(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(READ)], "i int, v string")
    got = {r.i: r.j for r in df.select("i", parsed_lines(F.col("v")).alias("p")).select("i", yaml_json(F.col("p")).alias("j")).collect()}
    for i, (doc, want) in enumerate(READ):
        assert got[i] is not None, doc
        assert json.loads(got[i]) == want, doc


def test_anything_else_is_refused(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(REFUSED)], "i int, v string")
    got = {r.i: r.j for r in df.select("i", parsed_lines(F.col("v")).alias("p")).select("i", yaml_json(F.col("p")).alias("j")).collect()}
    assert {REFUSED[i]: j for i, j in got.items() if j is not None} == {}


def test_refused_files_stop_the_job_or_are_rows(spark):
    import os
    path = scratch_path(spark, "yaml")
    root = path.replace("file:", "")
    os.makedirs(root)
    for name, text in (("good.yaml", "a: [1]\n"), ("bad.yaml", "a: &x 1\n"), ("empty.yaml", "\n"), ("list.yaml", "- 1\n")):
        with open(os.path.join(root, name), "w") as f:
            f.write(text)
    rows = SC.read_config_docs(spark, path, "yaml", refused="rows").collect()
    assert {(os.path.basename(r.file), r.key, r.value_json) for r in rows} == {("good.yaml", "a", "[1]"), ("bad.yaml", None, None), ("list.yaml", None, None)}
    with pytest.raises(Exception, match="no readable yaml mapping"):
        SC.read_config_docs(spark, path, "yaml").collect()
