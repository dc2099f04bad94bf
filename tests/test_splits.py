import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from firmlens.operators import splits
from firmlens.plans.backtest import relational_backtest
from tests.helpers import brute_auc, brute_pr_auc, close


def _month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


def _panel(spark, n, hot_month=False, seed=1):
    rng = random.Random(seed)
    rows = [(f, _month(0 if hot_month and rng.random() < 0.5 else rng.randrange(14)), rng.choice([0, 0, 1, 2]), rng.randrange(9) / 9) for f in range(n)]
    return rows, spark.createDataFrame(rows, "firm long, ym date, Y int, score double")


@pytest.mark.parametrize("n,folds,hot", [(60, 5, False), (61, 5, True), (97, 4, True), (12, 5, False), (7, 5, False)])
def test_blocks_match_row_numbers(spark, n, folds, hot):
    rows, df = _panel(spark, n, hot)
    order = sorted((ym, f) for f, ym, *_ in rows)
    size = n // (folds + 1)
    first = n - folds * size
    want = {f: 0 if i < first else (i - first) // size + 1 for i, (_, f) in enumerate(order)}
    got = {r.firm: r.block for r in splits.expanding_blocks(df, folds).collect()}
    assert got == want
    ranges = {(r.fold, r.role): r for r in splits.fold_ranges(splits.expanding_blocks(df, folds), folds).collect()}
    for f in range(1, folds + 1):
        assert ranges[f, "val"].n_rows == size
        assert ranges[f, "train"].last_row + 1 == ranges[f, "val"].first_row
        assert ranges[f, "train"].last_day <= ranges[f, "val"].first_day


def test_holdout_takes_last_distinct_years(spark):
    df = spark.createDataFrame([(y,) for y in (1999, 2001, 2002, 2005, 2005)], "year int")
    out = {r.year: r.role for r in splits.holdout_years(df, test_years=3).collect()}
    assert out == {1999: "train", 2001: "test", 2002: "test", 2005: "test"}


def test_window_starts_cover_span(spark):
    df = spark.createDataFrame([(date(2000, 5, 1),)], "ym date")
    got = sorted(r.window for r in splits.window_starts(df, 3, date(2000, 1, 1), date(2000, 4, 1)).collect())
    assert got == [date(2000, 3, 1), date(2000, 4, 1)]


def test_each_window_status(spark):
    rows = [
        ("a", 0, 0), ("a", 1, 0), ("a", 2, 0), ("a", 2, 1), ("a", 3, 1), ("a", 4, 2), ("a", 5, 0), ("a", 5, 1),
        ("b", 3, 2), ("b", 4, 0), ("b", 5, 2),
    ]
    df = spark.createDataFrame([(e, _month(m), y) for e, m, y in rows], "econ string, ym date, Y int")
    counts = splits.window_class_counts(df, ["econ"], 1, _month(0), _month(6))
    got = {(r.econ, r.window): r.status for r in splits.with_window_status(counts).collect()}
    a = [got["a", _month(m)] for m in range(7)]
    assert a == ["no_rows", "one_train_class", "one_train_class", "one_test_class", "one_test_class", "scored", "no_rows"]
    assert got["b", _month(4)] == "one_train_class" and got["b", _month(5)] == "one_test_class"
    only_exits = splits.with_window_status(spark.createDataFrame([(5, 3, 2, 0, 4, 0, 0, 4)], "train_n_rows int, train_n0 int, train_n1 int, train_n2 int, test_n_rows int, test_n0 int, test_n1 int, test_n2 int"))
    assert only_exits.first().status == "one_test_class"


def test_relational_backtest_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else "cold", _month(rng.randrange(20)), rng.choice([0, 0, 0, 1, 2]), rng.randrange(25) / 25) for _ in range(600)]
    df = spark.createDataFrame(rows, "econ string, ym date, Y int, score double")
    out = {(r.econ, r.date): r for r in relational_backtest(df, ["econ"], _month(0), _month(19), 12).collect()}
    for econ in ("hot", "cold"):
        for m in range(20):
            start = _month(m)
            mine = [(ym, y, s) for e, ym, y, s in rows if e == econ]
            train = [y for ym, y, _ in mine if ym < start]
            test = [(y, s) for ym, y, s in mine if start <= ym < _month(m + 12)]
            kept = [(y, s) for y, s in test if y != 2]
            if not train or not test:
                assert (econ, start) not in out
                continue
            row = out.get((econ, start))
            if len(set(train)) < 2:
                assert row.auc_score is None and row.pr_auc == 0.5 and row.test_positives == 0
                continue
            if len({y for y, _ in test}) < 2 or not kept:
                assert row is None
                continue
            ys, ss = zip(*kept)
            assert (row.train_size, row.test_size, row.test_positives, row.test_samples) == (len(train), len(test), sum(ys), len(kept))
            assert close(row.auc_score, brute_auc(ys, ss)) and close(row.pr_auc, brute_pr_auc(ys, ss))
