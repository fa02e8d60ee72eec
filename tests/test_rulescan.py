"""Many rules in one scan: every match with its place, against plain regular expressions."""

import random
import re
import time

from runledger.operators import rulescan as RS

RULES = "rule string, literals array<string>, pattern string"


def _texts(seed, n):
    r = random.Random(seed)
    bits = ['Token = "abcdefgh12"', 'x', "\n", "é日 ", 'API-KEY: "0123456789"', "-----BEGIN RSA PRIVATE KEY-----", "bearer abcdefghijklmnop.q", 'secret="short"', "İ", '"', 'password\t:\t"longenough"']
    return [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 40)))) for i in range(n)]


def test_every_match_with_line_and_offset(spark):
    rows = _texts(1, 200) + [(900, None), (901, ""), (5, _texts(1, 6)[5][1])]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "text", "id AS _n")
    got = sorted(tuple(r) for r in RS.scan(df, RS.secret_rules(spark), "text", ("id", "_n")).collect())
    want = sorted((i, i, rule, t[:m.start()].count("\n") + 1, m.start(), m[0]) for i, t in rows if t for rule, _, p in RS.SECRET_RULES for m in re.finditer(p, t))
    assert got == want and len({x[2] for x in got}) == 5
    none = spark.createDataFrame([], RULES)
    assert RS.scan(df, none, "text", ("id",)).count() == 0


def test_two_hundred_rules_take_less_than_twice_the_time_of_one(spark):
    words = " ".join(f"word{i} other{i * 7 % 1000}" for i in range(3000))
    df = spark.range(1500).selectExpr("id", f"concat('{words}', id) AS text").cache()
    df.count()
    rules = [(f"r{i}", [f"needle{i}x"], rf"needle{i}x=\w+") for i in range(200)]

    def seconds(k):
        frame = spark.createDataFrame(rules[:k], RULES)
        times = []
        for _ in range(3):
            t = time.perf_counter()
            assert RS.scan(df, frame, "text", ("id",)).count() == 0
            times.append(time.perf_counter() - t)
        return min(times)

    seconds(1)
    assert seconds(200) < 2 * seconds(1)
