import random
import re

import pytest
from pyspark.sql import functions as F

from wardlog import functions as X
from wardlog import schema as S


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_length_of_printed_lists(spark):
    rnd = random.Random(5)

    def thing(depth):
        kind = rnd.randint(0, 6 if depth else 4)
        if kind == 5:
            return [thing(depth - 1) for _ in range(rnd.randint(0, 4))]
        if kind == 6:
            return {f"k{i}": thing(depth - 1) for i in range(rnd.randint(0, 4))}
        return [True, None, 1.5, rnd.choice(["it's", 'say "x"', "both ' and \"", "True", "a, b", "\x1b[0m", "tab\there", "\u00e9", ""]), -3][kind]

    things = [[thing(3) for _ in range(rnd.randint(0, 6))] for _ in range(150)]
    things += [{f"k{i}": thing(2) for i in range(rnd.randint(0, 5))} for _ in range(50)]
    texts = [repr(x) for x in things]
    assert values(spark, X.list_length, texts) == [len(eval(t)) for t in texts]
    assert values(spark, X.list_length, ["plain", "", None, "[1, 2", "  [1, 2]"]) == [0, 0, 0, 0, 2]


SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\u00a0", "\u2003", "\u3000", "\u200b", "x", ""]


@pytest.mark.parametrize("name", list(S.PATTERNS))
def test_patterns_with_every_kind_of_space(spark, name):
    texts = [f"{a}{s}{b}" for a in ("su", "ip", "chmod", "chmod +", "ls", "echo", "rc", "x.sh", "x.pl") for s in SPACES for b in ("", "x", "77x", "root")]
    got = values(spark, lambda t: X.matches(t, name), texts)
    assert got == [bool(re.search(S.PATTERNS[name], t)) for t in texts]


def test_numbers_and_times(spark):
    assert values(spark, X.number_or_zero, ["1.5", " 2 ", "x", "", None, "NaN", "1e3", "-4"]) == [1.5, 2.0, 0.0, 0.0, 0.0, 0.0, 1000.0, -4.0]
    got = values(spark, lambda t: X.parse_ts(t).cast("string"), [
        "2024-01-01T05:06:07.123456Z", "2024-01-01 05:06:07", "2024-01-01T05:06:07+02:00", "2024-13-01", "soon", None, "2024-01-01"])
    assert got == ["2024-01-01 05:06:07.123456", "2024-01-01 05:06:07", "2024-01-01 05:06:07", None, None, None, "2024-01-01 00:00:00"]


def test_map_keys(spark):
    got = values(spark, lambda t: F.struct(*X.map_key(t)), ["(0, 1)", "2,3", "(-1, 10)", "none"])
    assert [tuple(r) for r in got] == [(0, 1), (2, 3), (-1, 10), (None, None)]


def test_levels(spark):
    df = spark.range(0, 23).select("id", X.threat_code(F.col("id")).alias("c"))
    assert [r["c"] for r in df.orderBy("id").collect()] == [0] * 5 + [1] * 5 + [2] * 13
    assert values(spark, lambda t: X.level_code(t), ["low", "medium", "high", "odd", None]) == [0, 1, 2, None, None]
    assert values(spark, X.prettify, ["privilege_escalation", "other"]) == ["Privilege Escalation", "Other"]


def test_numbers_that_do_not_fit(spark):
    texts = ["1e10", "-1e10", "2147483647", "2147483648", "Infinity", "NaN", "7.9", None]
    assert values(spark, X.int_or_zero, texts) == [0, 0, 2147483647, 0, 0, 0, 7, 0]
    df = spark.createDataFrame([("(99999999999, 2)",), ("1,2",), ("x",)], "key string")
    assert [tuple(r) for r in df.select(*X.map_key(F.col("key"))).collect()] == [(None, 2), (1, 2), (None, None)]
