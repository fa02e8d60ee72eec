"""Scan of texts for many rules at once (A-18).

Rules are a relation of (rule, literals, pattern). All literals of all rules are searched in one pass per
text by an automaton (no matter how many there are); only a rule one of whose literals occurs has its
pattern run, and every match is returned with its line and offset.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_RULES = 10_000
# Our rules for hard-coded secrets: (name, literals of which one must occur in lower case, pattern of a match).
SECRET_RULES = (
    ("token", ("token",), r'(?i)token[ \t]*[:=][ \t]*"[^"\n]{8,}"'),
    ("secret", ("secret",), r'(?i)secret[ \t]*[:=][ \t]*"[^"\n]{8,}"'),
    ("password", ("password",), r'(?i)password[ \t]*[:=][ \t]*"[^"\n]{8,}"'),
    ("api_key", ("apikey", "api_key", "api-key"), r'(?i)api[_-]?key[ \t]*[:=][ \t]*"[^"\n]{8,}"'),
    ("private_key", ("private key",), r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    ("bearer", ("bearer ",), r"(?i)bearer [0-9a-z._~+/-]{16,}"),
)
HIT_SCHEMA = "rule string, line int, offset int, match string"


def scan(docs: DataFrame, rules: DataFrame, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per match: ``keep`` columns, rule, line (from 1), offset (code points before it), match.

    ``rules`` (configuration, at most MOST_RULES rows): rule, literals (lower-case texts, one of which
    every match's text holds in any letter case), pattern (Python syntax, matches do not overlap). Null
    texts have no match; rows that repeat are scanned each. Columns of ``keep`` must not be called as
    those of a match.
    """
    found = rules.select("rule", "literals", "pattern").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    known = [(r.rule, list(r.literals), r.pattern) for r in found]
    src = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        compiled = [(rule, re.compile(pattern)) for rule, _, pattern in known]
        of: dict[str, set[int]] = {}
        for i, (_, literals, _) in enumerate(known):
            for x in literals:
                of.setdefault(x.lower(), set()).add(i)
        seek = ahocorasick.Automaton()
        for x, where in of.items():
            seek.add_word(x, where)
        if of:
            seek.make_automaton()
        for b in batches:
            at, out = [], []
            for n, text in enumerate(b.column(len(keep)).to_pylist()):
                if not text or not of:
                    continue
                wanted = set().union(*(where for _, where in seek.iter(text.lower())))
                ends = None
                for i in sorted(wanted):
                    rule, pattern = compiled[i]
                    for m in pattern.finditer(text):
                        if ends is None:
                            ends = [p for p, c in enumerate(text) if c == "\n"]
                        at.append(n)
                        out.append((rule, bisect_right(ends, m.start() - 1) + 1, m.start(), m[0]))
            cols = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(at, pa.int64())) for k in range(len(keep))),
                                              *(pa.array(c, t) for c, t in zip(cols, kinds))], [*keep, "rule", "line", "offset", "match"])

    schema = ", ".join([*(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep), HIT_SCHEMA])
    return src.mapInArrow(run, schema)


def secret_rules(spark) -> DataFrame:
    """The rules for hard-coded secrets as a relation."""
    return spark.createDataFrame([(r, list(x), p) for r, x, p in SECRET_RULES], "rule string, literals array<string>, pattern string")
