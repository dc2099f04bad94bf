import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from firmlens.operators import aggregates, metrics, scores
from firmlens.operators.ranges import quantile_cuts
from tests.helpers import brute_auc, brute_pr_auc, close


def _frame(spark, groups):
    rows = [(k, y, float(s)) for k, (ys, ss) in groups.items() for y, s in zip(ys, ss)]
    return spark.createDataFrame(rows, "k string, y int, s double")


def _groups(seed=3):
    rng = random.Random(seed)
    groups = {}
    for i, (n, levels, share) in enumerate([(40, 5, 0.3), (200, 1000, 0.1), (7, 2, 0.5), (300, 17, 0.02), (1, 1, 1.0)]):
        groups[f"g{i}"] = ([int(rng.random() < share) for _ in range(n)], [rng.randrange(levels) / levels for _ in range(n)])
    groups["no_pos"] = ([0, 0, 0], [0.1, 0.2, 0.2])
    groups["no_neg"] = ([1, 1], [0.3, 0.3])
    # One group that holds most of the rows.
    groups["hot"] = ([int(rng.random() < 0.2) for _ in range(1500)], [rng.random() ** 4 for _ in range(1500)])
    return groups


@pytest.mark.parametrize("cuts", [None, [], [0.05, 0.2, 0.2000001, 0.9], [-5.0], [7.0]])
def test_ranking_matches_brute_force_for_any_cuts(spark, cuts):
    groups = _groups()
    df = _frame(spark, groups)
    both = {r.k: r for r in scores.ranking_measures(df, ["k"], "y", "s", cuts).collect()}
    only = {r.k: r for r in scores.roc_auc(df, ["k"], "y", "s", cuts).collect()}
    assert both.keys() == only.keys() == groups.keys()
    for k, (ys, ss) in groups.items():
        assert close(both[k].auc, brute_auc(ys, ss)) and close(only[k].auc, brute_auc(ys, ss)), k
        assert close(both[k].pr_auc, brute_pr_auc(ys, ss)), k
        assert both[k].n_pos == sum(ys) and both[k].n_neg == len(ys) - sum(ys)


def test_one_class_groups(spark):
    out = {r.k: r for r in scores.ranking_measures(_frame(spark, _groups()), ["k"], "y", "s").collect()}
    assert out["no_pos"].auc is None and out["no_pos"].pr_auc == 0.5
    assert out["no_neg"].auc is None and out["no_neg"].pr_auc == 1.0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=30))
def test_auc_properties(spark, rows):
    df = spark.createDataFrame([("a", y, float(s)) for y, s in rows], "k string, y int, s double")
    up = scores.roc_auc(df, ["k"], "y", "s").first().auc
    down = scores.roc_auc(df.withColumn("s", -F.col("s")), ["k"], "y", "s").first().auc
    curved = scores.roc_auc(df.withColumn("s", F.exp("s")), ["k"], "y", "s").first().auc
    ar = metrics.accuracy_ratio(df, ["k"], "y", "s").first().ar
    if up is None:
        assert down is None and curved is None and ar is None
    else:
        assert abs(up + down - 1) < 1e-12 and abs(up - curved) < 1e-12 and abs(ar - (2 * up - 1)) < 1e-12


def test_curves_end_at_the_corner(spark):
    df = _frame(spark, _groups())
    roc = scores.roc_curve(df, ["k"], "y", "s").where("k = 'hot'").orderBy(F.col("threshold").desc()).collect()
    assert (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(roc, roc[1:]))
    pr = scores.pr_curve(df, ["k"], "y", "s").where("k = 'hot'").orderBy("threshold").first()
    assert pr.rec == 1.0


def test_cuts_are_few_and_ordered(spark):
    df = spark.range(1000).selectExpr("cast(id as double) s")
    cuts = quantile_cuts(df, "s", 10)
    assert len(cuts) == 9 and cuts == sorted(cuts)
    assert quantile_cuts(df.withColumn("s", F.lit(1.0)), "s", 10) == [1.0]


def test_macro_counts_predicted_only_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (1, 1)], "y int, yhat int").withColumn("k", F.lit(1))
    row = metrics.macro_measures(df, ["k"]).first()
    # class 0: prec 1, rec .5; class 1: prec .5, rec .5; class 2: prec 0, rec 0 (never a label)
    assert close(row.precision_macro, 0.5) and close(row.recall_macro, 1 / 3) and close(row.f1_macro, (2 / 3 + 0.5 + 0) / 3)


def test_reference_comparison(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)]
    df = spark.createDataFrame(rows, "model string, y int, p1 double")
    row = metrics.compare_to_reference(df, "model", "a", "b").first()
    assert (row.auc_current, row.auc_reference, row.auc_difference, row.passed) == (1.0, 0.0, -1.0, False)
    assert metrics.compare_to_reference(df, "model", "a", "a").first().passed
    assert metrics.compare_to_reference(df, "model", "a", None).first().passed


def test_registry_names(spark):
    df = spark.createDataFrame([(1, 0, 0, [0.7, 0.2, 0.1]), (1, 1, 0, [0.5, 0.4, 0.1]), (1, 2, 2, [0.1, 0.1, 0.8])], "k int, y int, yhat int, p array<double>")
    for name in metrics.REGISTRY:
        assert metrics.measure(name, df, ["k"]).count() >= 1


def _curve(rows):
    """(threshold, fps, tps) by definition, from the highest score down."""
    out = []
    for cut in sorted({s for _, s in rows}, reverse=True):
        called = [y for y, s in rows if s >= cut]
        out.append((cut, sum(y != 1 for y in called), sum(y == 1 for y in called)))
    return out


@pytest.mark.parametrize("cuts", [[], [0.5], [0.05 * k for k in range(1, 20)], [0.1, 0.1001, 0.6]])
def test_curve_without_collinear_points(spark, cuts):
    rng = random.Random(len(cuts))
    groups = {
        "mixed": [(rng.randrange(2), round(rng.random(), 1 + rng.randrange(2))) for _ in range(200)],
        "hot": [(k % 2, 0.5) for k in range(300)] + [(1, 0.1), (0, 0.9)],
        "even": [(y, s / 20) for s in range(20) for y in (0, 1)],  # one straight line
        "positive": [(1, s / 10) for s in (1, 2, 3, 3, 5)], "single": [(0, 0.3)],
    }
    df = spark.createDataFrame([(g, y, s) for g, rows in groups.items() for y, s in rows], "g string, y int, s double")
    got = {g: {} for g in groups}
    for r in scores.roc_curve(df, ["g"], "y", "s", cuts=cuts, drop_collinear=True).collect():
        got[r.g][r.threshold] = (r.fpr, r.tpr)
    for g, rows in groups.items():
        points = _curve(rows)
        fps, tps = [p[1] for p in points], [p[2] for p in points]
        kept = [i for i in range(len(points)) if i in (0, len(points) - 1) or fps[i + 1] - 2 * fps[i] + fps[i - 1] or tps[i + 1] - 2 * tps[i] + tps[i - 1]]
        share = lambda a, b: a / b if b else None
        assert got[g] == {points[i][0]: (share(fps[i], fps[-1]), share(tps[i], tps[-1])) for i in kept}, g


def test_both_curves_on_one_axis(spark):
    rng = random.Random(8)
    rows = [(g, m, rng.randrange(2) if g != 2 else 0, round(rng.random(), 2)) for g in (1, 2) for m in ("a", "b", "c") for _ in range(60)]
    rows += [(3, "a", 1, 0.5), (3, "a", 0, 0.4), (1, "a", 1, None), (1, "b", None, 0.123), (1, "a", 0, float("nan"))]
    df = spark.createDataFrame(rows, "g int, m string, y int, s double")
    got = {(r.g, r.threshold): r[2:] for r in scores.roc_curves_of_two(df, ["g"], "m", "a", "b", "y", "s").collect()}
    want = {}
    for g in (1, 2, 3):
        known = {m: [(y, s) for h, n, y, s in rows if (h, n) == (g, m) and y is not None and s is not None and s == s] for m in "ab"}
        for cut in {s for v in known.values() for _, s in v}:
            point = []
            for m in "ab":
                for label in (0, 1):
                    of = [s for y, s in known[m] if y == label]
                    point.append(sum(s >= cut for s in of) / len(of) if of else None)
            want[g, cut] = tuple(point)
    assert got == want


def test_merged_profile_of_sketches(spark):
    rng = random.Random(4)
    rows = [(g, m, rng.choice([None, float("nan"), rng.gauss(0, 5), float(rng.randrange(50))])) for g in "ab" for m in range(12) for _ in range(400)]
    rows += [("c", 0, None), ("c", 1, None), ("d", 0, 2.5)]
    df = spark.createDataFrame(rows, "g string, m int, x double")
    parts = aggregates.profile_parts(df, ["g", "m"], ["x"])
    assert parts.count() == 27
    got = {}
    for r in aggregates.merged_profile(parts, ["g"]).collect():
        got.setdefault(r.g, {})[r.stat] = r.value
    for g in "abcd":
        values = sorted(x for h, _, x in rows if h == g and x is not None and x == x)
        mine, n = got[g], len(values)
        assert (mine["count"], mine["missing"]) == (n, sum(h == g for h, _, _ in rows) - n)
        if not n:
            assert mine["q50"] is None and mine["distinct"] == 0 and mine["mean"] is None
            continue
        mean = sum(values) / n
        assert abs(mine["mean"] - mean) < 1e-9 and (mine["min"], mine["max"]) == (values[0], values[-1])
        assert mine["std"] is None if n == 1 else abs(mine["std"] - (sum((v - mean) ** 2 for v in values) / (n - 1)) ** 0.5) < 1e-9
        assert abs(mine["distinct"] - len(set(values))) <= 0.025 * len(set(values))
        for q in (0.25, 0.5, 0.75):
            estimate = mine[f"q{round(100 * q)}"]
            assert sum(v < estimate for v in values) / n - 0.01 <= q <= sum(v <= estimate for v in values) / n + 0.01 or n == 1
