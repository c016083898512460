"""Ranks, splits, metrics, scaling and responses against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.operators import metrics as M
from wardlog.operators import respond as R
from wardlog.operators import sampling as SA
from wardlog.operators import scaling as SC
from wardlog.operators.ranks import dense_index


def order(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def labelled(spark):
    """Label 0 holds most rows; label 7 and a NULL label have very few."""
    rnd = random.Random(3)
    data = [(i, 0 if rnd.random() < 0.7 else rnd.choice([1, 2])) for i in range(900)] + [(900, 7), (901, 7), (902, None)]
    return data, spark.createDataFrame(data, "id long, label int").repartition(5)


def strata(data):
    out = defaultdict(list)
    for i, label in data:
        out[label].append(i)
    return {k: sorted(v, key=lambda i: (order(i), i)) for k, v in out.items()}


def test_stratified_split(labelled):
    data, df = labelled
    got = {r["id"] for r in SA.stratified_split(df).where("is_test").collect()}
    want = {i for ids in strata(data).values() for i in ids[: math.floor(len(ids) * 0.25 + 0.5)]}
    assert got == want


def test_large_sides_are_not_broadcast(spark, labelled, monkeypatch):
    from wardlog import session

    data, df = labelled
    monkeypatch.setattr(session, "BROADCAST_ROWS", 2)
    out = SA.stratified_split(df)
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    want = {i for ids in strata(data).values() for i in ids[: math.floor(len(ids) * 0.25 + 0.5)]}
    assert {r["id"] for r in out.where("is_test").collect()} == want


def test_folds(labelled):
    data, df = labelled
    got = {r["id"]: r["fold"] for r in SA.kfold(df).collect()}
    assert len(got) == len(data)
    for ids in strata(data).values():
        sizes = Counter(got[i] for i in ids)
        assert max(sizes.values()) - min(sizes.get(f, 0) for f in range(min(5, len(ids)))) <= 1
        assert [got[i] for i in ids] == sorted(got[i] for i in ids)


def test_dense_index(labelled):
    data, df = labelled
    got = [r["id"] for r in dense_index(df, "id", 42).orderBy("row_index").collect()]
    assert got == sorted((i for i, _ in data), key=lambda i: (order(i), i))


def test_random_split_is_narrow(labelled):
    _, df = labelled
    plan = SA.random_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "SortMergeJoin" not in plan


def test_random_split_takes_the_exact_share(labelled):
    data, df = labelled
    ids = sorted((i for i, _ in data), key=lambda i: (order(i), i))
    for share in (0.0, 0.25, 0.333, 1.0):
        got = {r["id"] for r in SA.random_split(df, test_size=share).where("is_test").collect()}
        assert got == set(ids[:int(len(ids) * share + 0.5)])


def test_repair_moves_rows_once(spark):
    data = [(i, 0, i < 20) for i in range(100)] + [(i, 1, False) for i in range(100, 140)] + [(i, 2, False) for i in range(200, 205)] + [
        (i, 3, False) for i in range(300, 400)]
    split = spark.createDataFrame(data, "id long, label int, is_test boolean")
    fixed = SA.repair_test_classes(split)
    rows = fixed.collect()
    assert sorted(r["id"] for r in rows) == sorted(d[0] for d in data)
    moved = Counter(r["label"] for r in rows if r["is_test"] and r["label"] != 0)
    assert moved == {1: 4, 3: 5}  # 10 % of 40, at most 5 of 100, none of 5
    assert {r["label"] for r in SA.missing_classes(split).collect()} == {1, 2, 3}


def test_kind_of_split_follows_the_smallest_class(spark):
    def table(n):
        return spark.createDataFrame([(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(n)], "id long, label int")

    assert [SA.needs_stratified(table(n)) for n in (0, 1, 2, 9, 10)] == [False, False, True, True, False]
    strat = {r["id"] for r in SA.improved_split(table(8)).where("is_test").collect()}
    assert len(strat) == 15 + 2
    plain = {r["id"] for r in SA.improved_split(table(20)).where("is_test").collect()}
    assert plain == set(sorted([*range(60), *range(100, 120)], key=lambda i: (order(i), i))[:20])


def test_group_limit_before_the_shuffle(spark):
    split = spark.createDataFrame([(i, 1, False) for i in range(50)], "id long, label int, is_test boolean")
    assert "WindowGroupLimit" in SA.repaired_rows(split)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n", [1, 3, 7, 200])
def test_drawn_rows(spark, n):
    df = spark.createDataFrame([(i, 0) for i in range(n)], "id long, label int")
    out = SA.synthesize_minority(df).collect()
    new = [r for r in out if r["label"] == 1]
    assert len(out) == n + max(5, int(n * 0.1)) and len(new) == max(5, int(n * 0.1))
    ids = sorted(range(n), key=lambda i: (order(i), i))
    want = Counter(ids[int(hashlib.md5(f"42|draw|{j}".encode()).hexdigest()[:15], 16) % n] for j in range(len(new)))
    assert Counter(r["id"] for r in new) == want
    both = spark.createDataFrame([(1, 0), (2, 1)], "id long, label int")
    assert SA.synthesize_minority(both).count() == 2


def test_noise_is_normal_and_repeatable(spark):
    df = spark.range(4000).withColumn("x", F.lit(1.0))
    noisy = SA.with_noise(df, ["x"], level=0.05)
    stats = noisy.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(stats[0] - 1) < 0.005 and abs(stats[1] - 0.05) < 0.003
    assert noisy.agg(F.sum("x")).first()[0] == pytest.approx(SA.with_noise(df, ["x"]).agg(F.sum("x")).first()[0])


@pytest.mark.parametrize("size", [1, 2, 5, 1000, 30_001])
def test_exact_medians(spark, size):
    rnd = random.Random(size)
    data = [(float(rnd.choice([0, 0, rnd.random() * 100])), rnd.randint(0, 3) if rnd.random() < 0.9 else None) for _ in range(size)]
    df = spark.createDataFrame(data, "a double, b int")

    def median(v):
        v = sorted(x for x in v if x is not None)
        return None if not v else (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2

    got = {r["feature"]: r["median"] for r in SC.exact_medians(df, ["a", "b"]).collect()}
    assert got.get("a") == median(d[0] for d in data) and got.get("b") == median(d[1] for d in data)


@pytest.mark.parametrize("kept", [1, 7, 200])
def test_medians_in_rounds(spark, monkeypatch, kept):
    """Brackets narrow to a few values, also where one value holds most rows or stands beside the middle."""
    monkeypatch.setattr(SC, "KEPT", kept)
    monkeypatch.setattr(SC, "ACCURACY", 20)
    rnd = random.Random(kept)
    columns = {
        "heavy": [0.0] * 3000 + [rnd.random() for _ in range(1000)], "beside": [1.0] * 2000 + [rnd.uniform(2, 3) for _ in range(2000)],
        "even": [rnd.gauss(0, 1e6) for _ in range(4000)], "few": [float(n % 3) if n % 2 else None for n in range(4000)], "none": [None] * 4000,
    }
    for values in columns.values():
        rnd.shuffle(values)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = {r["feature"]: r["median"] for r in SC.exact_medians(df, list(columns)).collect()}
    for name, values in columns.items():
        v = sorted(x for x in values if x is not None)
        assert got.get(name) == (None if not v else (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2), name
    plan = SC.exact_medians(df, list(columns))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("ranges", [None, 1, 13])
def test_running_totals_with_a_dominant_class(spark, ranges):
    from wardlog.operators.ranks import running_totals

    data = [("most", float(n * 7919 % 9973), n % 5, 1) for n in range(3000)] + [("few", float(n), 2, n) for n in range(9)]
    df = spark.createDataFrame(data, "c string, s double, a long, b long").repartition(4)
    found = running_totals(df, "c", "s", ["a", "b"], ranges).collect()
    assert len(found) == len(data)
    for name in ("most", "few"):
        rows = sorted((r for r in found if r["c"] == name), key=lambda r: -r["s"])
        a = b = 0
        for r in rows:
            a, b = a + r["a"], b + r["b"]
            assert (r["cum_a"], r["cum_b"]) == (a, b)
        assert {(r["total_a"], r["total_b"]) for r in rows} == {(a, b)}


def test_scaling_is_by_population(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "a double, b int")
    got = [r["a"] for r in SC.standard_scale(df, ["a", "b"]).collect()]
    mean, std = 7 / 3, math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3)
    assert got == pytest.approx([(v - mean) / std for v in (1, 2, 4)])
    assert [r["b"] for r in SC.standard_scale(df, ["a", "b"]).collect()] == [0.0] * 3
    staged = SC.prepare_stage(["a", "b"], {"a": 2.0}, SC.collect_moments(df, ["a", "b"])).transform(df)
    assert [r["x_a"] for r in staged.collect()] == pytest.approx(got)


def test_metrics_on_a_fixed_table(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 3)] + [(2, 0)] * 2
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = {r["class"]: r for r in M.class_report(df).collect()}
    assert got[0]["precision"] == 5 / 7 and got[0]["recall"] == 5 / 7 and got[2]["f1"] == 0.0 and got[3]["support"] == 0
    w = M.weighted_metrics(df).first()
    assert w["accuracy"] == 8 / 13
    assert w["recall"] == pytest.approx((7 * 5 / 7 + 4 * 3 / 4) / 13)
    assert M.macro_metrics(df).first()["recall"] == pytest.approx((5 / 7 + 3 / 4 + 0 + 0) / 4)


@pytest.mark.parametrize("buckets", [2, 16, 256, None])
def test_roc_and_auc(spark, buckets):
    rnd = random.Random(buckets)
    data = [(c, rnd.randint(0, 2), rnd.choice([0.5, rnd.random(), round(rnd.random(), 1)])) for c in (0, 1, 2) for _ in range(300)]
    df = spark.createDataFrame(data, "class int, label int, score double")
    auc = {r["class"]: r["auc"] for r in M.roc_auc(df, buckets).collect()}
    points = defaultdict(list)
    for r in M.roc_points(df, buckets).collect():
        points[r["class"]].append((r["fpr"], r["tpr"]))
    for c in (0, 1, 2):
        pos = [s for k, l, s in data if k == c and l == c]
        neg = [s for k, l, s in data if k == c and l != c]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
        assert auc[c] == pytest.approx(want, abs=1e-12)
        curve = sorted(points[c])
        assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)
        assert sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:])) == pytest.approx(want, abs=1e-9)
        assert len(curve) == len(set(pos + neg)) + 1


def test_elbow_takes_the_first_of_equal_bends(spark):
    df = spark.createDataFrame(list(zip(range(2, 8), [100.0, 50.0, 40.0, 0.0, 0.0, 0.0])), "k int, inertia double")
    assert M.elbow(df).first()["k"] == 3  # bends 40, 30, 40, 0 at k = 3..6


def test_best_model_prefers_the_first_of_equal_ones(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.9), ("c", 2, 0.9), ("d", 3, None)], "model string, position int, f1 double")
    assert M.best_model(df).first()["model"] == "b"


def test_response_tables(spark):
    rows = spark.createDataFrame([(t, c) for t in (0, 1, 2) for c in range(4)], "threat_code int, cluster int")
    grid = {(r["threat_code"], r["cluster"]): r["response_level"] for r in R.response_map_cluster_rule(rows).collect()}
    assert grid == {(t, c): t or int(c in S.RECON_CLUSTERS) for t in (0, 1, 2) for c in range(4)}
    asked = spark.createDataFrame([(2, 9), (None, 1), (1, None), (0, 2)], "threat_code int, cluster int")
    got = sorted(r["response_level"] for r in R.response_lookup(asked, R.response_map_cluster_rule(rows)).collect())
    assert got == [0, 0, 1, 1]
    odd = spark.createDataFrame([(5, 0, 3)], "threat_code int, cluster int, response_level int")
    assert R.report_table(odd).first()[:] == ("Unknown", 0, "Unknown")
    assert R.strategy_decode(odd).first()["strategy"] == "low"


def test_state_views(spark):
    d = spark.createDataFrame([("a", 2, "1"), ("a", 0, "3"), ("b", 1, "2")], "session_id string, response_level int, timestamp string")
    assert {r["session_id"]: r["strategy"] for r in R.active_sessions(d).collect()} == {"a": "low", "b": "medium"}
    assert R.highest_level(d).first()["strategy"] == "medium"
    assert R.highest_level(d, since="3").first()["response_level"] == 0
    steps = spark.createDataFrame([(0, 0), (1, 2), (2, 1)], "step int, response_level int")
    got = [(r["highest_level"], r["changed"]) for r in R.desired_profile(steps).orderBy("step").collect()]
    assert got == [(0, True), (2, True), (2, False)]
