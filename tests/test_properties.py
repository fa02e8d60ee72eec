"""Property checks (hypothesis) of the text rules.

Examples are drawn first and evaluated in one Spark job per property.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runledger.functions import text as T

ALPHABET = st.sampled_from(list("ab é\n{}[]`jsonè\t"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=120), min_size=20, max_size=60)
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in df.select("i", fn(F.col("s"))).orderBy("i").collect()]


@SETTINGS
@given(values=TEXTS)
def test_extract_json_property(spark, values):
    fenced = ["```json\n" + v + "\n```" for v in values[:5] if "`" not in v]
    out = _apply(spark, T.extract_json, values + fenced)
    assert all(o in v for o, v in zip(out, values + fenced))
    for v, o in zip(fenced, out[len(values):]):
        inner = v[8:-4].strip()
        assert o in inner and (o == inner or o == "" or o[0] in "[{")


@SETTINGS
@given(values=TEXTS, n=st.integers(min_value=1, max_value=90))
def test_truncate_property(spark, values, n):
    suffix = "... (truncated)"
    for v, o in zip(values, _apply(spark, lambda c: T.truncate_text(c, n), values)):
        assert o == v if len(v) <= n else o.endswith(suffix) and v.startswith(o.removesuffix(suffix)) and len(o) <= max(n, len(suffix))


@SETTINGS
@given(values=TEXTS, n=st.integers(min_value=2, max_value=60))
def test_head_tail_property(spark, values, n):
    for v, o in zip(values, _apply(spark, lambda c: T.head_tail(c, n), values)):
        half = n // 2
        assert o == v if len(v) <= n else v.startswith(o[:half]) and v.endswith(o[len(o) - half:]) and "SUMMARIZED" in o
