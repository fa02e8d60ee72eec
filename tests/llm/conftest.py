import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table from (doc_id, text[, lang, source]) rows."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s0")), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def sentence(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def spark():
    import os
    import sys
    import tempfile

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.path.insert(0, root)
    os.environ["PYTHONPATH"] = root + os.pathsep + os.environ.get("PYTHONPATH", "")
    from runledger.session import get_spark
    return get_spark("runledger-tests", master="local[4]", shuffle_partitions=4,
                     extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="runledger-test-ckpt-")})


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, repeated rows, a very long text, ties."""
    long_text = "\n".join(sentence(i, 40) for i in range(300))
    return [(1, None, None, None), (2, "", "en", None), (3, " \t\n ", None, "a"), (None, "some words without an id", "en", "a"),
            (4, sentence(4, 30), "en", "a"), (4, sentence(4, 30), "en", "a"), (5, sentence(4, 30), "en", "b"),
            (6, long_text, "de", "b"), (7, "x", "de", "b"), (8, "１２ 日本語 テキスト!\n日本語 テキスト!", "ja", "b")]
