from datetime import date

import pytest
from pyspark.sql import functions as F

from firmlens.functions import columns as c
from firmlens.operators import aggregates, joins, labels, prep


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert sorted((r.x is None, r.x) for r in c.blank_to_null(df).collect() if r.x is not None) == [(False, 1.0)]
    assert c.blank_to_null(df).where("x IS NULL").count() == 2


def test_sentinel_keeps_missing_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (None,)], "Y int")
    assert sorted((r.Y is None, r.Y or 0) for r in prep.drop_unusable(df).collect()) == [(False, 0), (False, 1), (True, 0)]


def test_defaulted_rows_are_filled(spark):
    df = spark.createDataFrame([(1, None, None), (0, None, 2.0)], "Y int, a double, b double")
    rows = {r.Y: (r.a, r.b) for r in prep.fill_defaulted(df).collect()}
    assert rows == {1: (0.0, 0.0), 0: (None, 2.0)}


@pytest.mark.parametrize("day,ahead,back", [
    (date(2024, 1, 31), "N/A", "2023-12-31"),
    (date(2024, 12, 15), "2025-01-15", "2024-11-15"),
    (date(2024, 3, 31), "N/A", "N/A"),
    (date(2024, 2, 29), "2024-03-29", "2024-01-29"),
    (date(2024, 1, 10), "2024-02-10", "2023-12-10"),
])
def test_same_day_of_neighbour_months(spark, day, ahead, back):
    df = spark.createDataFrame([(day,)], "d date")
    row = df.select(c.add_one_month_text("d").alias("a"), c.subtract_one_month_text("d").alias("b")).first()
    assert (row.a, row.b) == (ahead, back)


def test_missing_date_is_na(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(c.add_one_month_text("d").alias("a")).first().a == "N/A"


def test_bad_date_numbers_are_null(spark):
    df = spark.createDataFrame([(20240131,), (20240231,)], "d int")
    assert [r.x for r in df.select(c.date_from_ints("d").alias("x")).collect()] == [date(2024, 1, 31), None]


def test_event_descriptions(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (7.0,), (None,)], "e double")
    assert [r.t for r in df.select(c.event_description("e").alias("t")).collect()] == [
        "No Default", "Default", "Exit the Market", "Unknown", "NaN"]


def test_argmax_takes_first_on_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],)], "p array<double>")
    assert [r.k for r in df.select(c.argmax_class("p").alias("k")).collect()] == [0, 2]


def test_search_ignores_case_and_missing(spark):
    df = spark.createDataFrame([("Acme", None), (None, "ACM.X"), ("Other", "x")], "name string, ticker string")
    assert prep.search_text(df, "acm", ["name", "ticker"]).count() == 2
    assert prep.search_text(df, "", ["name", "ticker"]).count() == 3
    assert prep.search_text(df, "acm.x", ["name", "ticker"]).count() == 1
    assert prep.search_text(df, "a.m", ["name", "ticker"], regex=True).count() == 2


def _panel(spark, months, labels_):
    return spark.createDataFrame([(1, date(2000 + (m - 1) // 12, (m - 1) % 12 + 1, 1), y) for m, y in zip(months, labels_)], "firm long, ym date, Y int")


def test_lead_counts_rows_and_calendar_counts_months(spark):
    df = _panel(spark, [1, 2, 4, 5], [0, 1, 2, 0])
    by_rows = [r.Y for r in labels.lead_label(df, 2).orderBy("ym").collect()]
    assert by_rows == [2, 0, None, None]
    by_calendar = [r.Y_ahead for r in labels.lead_label_calendar(df, 2).orderBy("ym").collect()]
    assert by_calendar == [None, 2, None, None]
    assert [r.Y for r in labels.lead_label_known(df, 3).collect()] == [0]


def test_fill_along(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, None), (2, 1, None)], "firm long, t int, g string")
    out = labels.fill_along(df, ["g"], ["firm"], ["t"]).orderBy("firm", "t").collect()
    assert [r.g for r in out] == ["a", "a", "a", None]


def test_rolling_needs_full_frame(spark):
    df = spark.createDataFrame([(1, t, float(t)) for t in range(1, 5)], "k int, t int, v double")
    out = labels.rolling_mean(df, "v", 3, ["k"], ["t"], "m").orderBy("t").collect()
    assert [r.m for r in out] == [None, None, 2.0, 3.0]


def test_current_and_previous_event(spark):
    rows = [(1, "2024-02-01", date(2024, 1, 1), 0), (1, "2024-02-01", date(2024, 1, 5), 1), (2, "2024-02-01", date(2024, 1, 2), None)]
    df = spark.createDataFrame(rows, "comp long, task string, day date, kind int")
    out = {r.comp: r for r in aggregates.current_and_previous(df, ["comp", "task"], "day", "kind").collect()}
    assert (out[1].current_date, out[1].current_event_type, out[1].previous_date, out[1].previous_event_type) == ("2024-01-05", "1", "2024-01-01", "0")
    assert (out[2].current_event_type, out[2].previous_date, out[2].previous_event_type) == ("NaN", "NaN", "NaN")


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "Y int")
    weights = {r.Y: r.weight for r in aggregates.class_weights(df).collect()}
    assert weights == {0: 4 / (2 * 3), 1: 4 / (2 * 1)}


def test_calendar_spine(spark):
    df = spark.createDataFrame([("a", 2027, "x", 1.0), ("b", 2028, None, 2.0)], "firm string, Year int, txt string, num double")
    out = {(r.firm, r.Year): (r.txt, r.num) for r in joins.calendar_spine(df, "firm", "Year", ["txt"], ["num"]).collect()}
    assert len(out) == 8
    assert out["a", 2030] == ("x", None) and out["b", 2027] == (None, None) and out["b", 2028] == (None, 2.0)


def test_profile_exact_matches_numpy(spark):
    import numpy as np

    values = [float(v) for v in (3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5)]
    df = spark.createDataFrame([("k", v) for v in values] + [("k", None)], "part string, v double")
    out = {r.stat: r.value for r in aggregates.data_profile(df, ["part"], ["v"]).collect()}
    assert out["count"] == 11 and out["missing"] == 1 and out["distinct"] == 7
    for name, q in (("q25", 25), ("q50", 50), ("q75", 75)):
        assert abs(out[name] - np.percentile(values, q)) < 1e-12
