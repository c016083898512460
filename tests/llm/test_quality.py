import re
from collections import Counter

from tests.llm.conftest import prose, rows
from wardlog.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            inside |= set(range(i, i + 5))
    n_stop = sum(x.lower() in Q.STOP_WORDS for x in w)
    counts = [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines), n_stop]
    base = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    ok = (2000 * len(w) <= 1000 * counts[1] <= 12000 * len(w) and 1000 * counts[2] <= 100 * len(w)
          and (len(w) < 50 or 1000 * n_stop >= 20 * len(w)) and 1000 * counts[3] <= 500 * len(lines))
    return (*counts, base, not base and ok)


def judged(df):
    out = Q.quality_rules(df, out="score")
    return sorted(((r["text"], *[r["score"][n] for n in (*Q.COUNTS, "base_failed", "kept")]) for r in out.collect()), key=repr)


def test_counts_and_verdicts(spark, edge):
    extra = ["a b c d e a b c d e f", "a a a a a a a a a a a a", "x y z w v " * 4 + prose(9), "l one\nl one\n\n \nl one\ntwo " + prose(5),
             "| a | b | c " * 9, "### " + prose(6), " ".join(f"{n}$" for n in range(40)), "averyveryveryverylongword " * 4 + "b c d e f g h",
             " ".join(f"q{n}z" for n in range(60)), "\x0b".join("abcdefghijk"), " ".join("abcdefghijk")]
    df = edge.select("text", "score").union(spark.createDataFrame([(t, "s") for t in extra], "text string, score string"))
    expected = sorted(((r["text"], *brute(r["text"])) for r in df.collect()), key=repr)
    assert judged(df) == expected


def test_empty_frame(nothing):
    assert Q.quality_rules(nothing).count() == 0


def test_broken_rules_are_named(spark):
    df = spark.createDataFrame([("$$$ " * 30 + prose(1, 60),)], "text string")
    assert Q.quality_rules(df).first()["quality"]["broken"] == ["symbols"]


def test_one_projection_without_python(edge):
    plan = Q.quality_rules(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert rows(Q.quality_rules(edge).select("doc_id")) == rows(edge.select("doc_id"))
