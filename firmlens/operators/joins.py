"""Joins between predictions, outcomes, metadata and result series.

No broadcast is forced here: none of these inputs has a proven size. Spark broadcasts a side by itself when
its statistics (or, with adaptive execution, its measured shuffle size) are below the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.columns import date_from_ints, padded_date_text
from firmlens.functions.constants import SPINE_LAST_YEAR
from firmlens.operators.labels import fill_along
from firmlens.operators.prep import with_forecast_date
from firmlens.session import stored

PREDICTION_KEYS = ["comp_id", "yyyymmdd", "task_date"]


def result_table(stats: DataFrame, model: DataFrame, truth: DataFrame) -> DataFrame:
    """Statistical predictions with the model's predictions and the outcome of the same firm, day and load.

    The joins use the DATE of the padded text, so two-digit years meet their century; a day that does not exist
    keeps its row and its text and meets nothing.
    """
    left = stats.select(
        "comp_id",
        padded_date_text("yy", "mm", "dd").alias("yyyy_mm_dd"),
        F.col("pd_1").alias("stats_pd_1"),
        F.col("poe_1").alias("stats_poe_1"),
        "task_date",
    ).withColumn("yyyymmdd", date_from_ints("yyyy_mm_dd", "yyyy-MM-dd"))
    ml = model.select(*PREDICTION_KEYS, F.col("pd_1").alias("ml_pd_1"), F.col("poe_1").alias("ml_poe_1"))
    events = truth.select(*PREDICTION_KEYS, "event_type")
    return (
        left.join(ml, PREDICTION_KEYS, "left")
        .join(events, PREDICTION_KEYS, "left")
        .select("comp_id", "yyyy_mm_dd", "stats_pd_1", "stats_poe_1", "ml_pd_1", "ml_poe_1", "task_date", "event_type")
    )


def merged_predictions(stats: DataFrame, model: DataFrame, truth: DataFrame) -> DataFrame:
    """All firm-days that either source predicts, with the outcome and the forecast date, unsorted."""
    s = stats.select(*PREDICTION_KEYS, F.col("pd_1").alias("stats_pd_1"), F.col("poe_1").alias("stats_poe_1"))
    m = model.select(*PREDICTION_KEYS, F.col("pd_1").alias("ml_pd_1"), F.col("poe_1").alias("ml_poe_1"))
    t = truth.select(*PREDICTION_KEYS, "event_type")
    both = s.join(m, PREDICTION_KEYS, "full_outer")
    return with_forecast_date(both.join(t, PREDICTION_KEYS, "left"))


def country_metrics(
    econ: DataFrame, model: DataFrame, metrics: DataFrame, metrics_type: DataFrame,
    econ_name: str | None = None, metric_name: str | None = None,
) -> DataFrame:
    """(econ_name, metrics_name, value) over the metadata star, optionally for one economy and metric."""
    if econ_name is not None:
        econ = econ.where(F.col("econ_name") == econ_name)
    if metric_name is not None:
        metrics_type = metrics_type.where(F.col("metrics_name") == metric_name)
    return (
        metrics.join(metrics_type, "metrics_type_id")
        .join(model.select("model_id", "econ_id"), "model_id")
        .join(econ.select("econ_id", "econ_name"), "econ_id")
        .select("econ_name", "metrics_name", "value")
    )


def economies_with_results(econ: DataFrame, model_results: DataFrame, stats_results: DataFrame, horizons=(1, 12)) -> DataFrame:
    """Economies that have a scored model backtest or a statistical series."""
    scored = model_results.where(
        F.col("horizon").isin(*horizons) & (F.col("auc_score").isNotNull() | F.col("pr_auc").isNotNull())
    )
    ids = scored.select(F.col("econ").alias("econ_id")).union(stats_results.select(F.col("econ").alias("econ_id"))).distinct()
    return econ.join(ids, "econ_id", "left_semi")


def companies_with_predictions(info: DataFrame, predictions: DataFrame, key: str, predicted_key: str = "comp_id") -> DataFrame:
    """Company rows that occur among the predictions."""
    return info.join(predictions.select(F.col(predicted_key).alias(key)), key, "left_semi")


def model_comparison(stats: DataFrame, model: DataFrame, keys: list[str], suffixes=("_model1", "_model2"), scored_only=True) -> DataFrame:
    """Two result series side by side on their dates; rows of the second without an AUC are left out first."""
    if scored_only:
        model = model.where(F.col("auc_score").isNotNull())
    shared = [c for c in stats.columns if c in model.columns and c not in keys]
    a = stats.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = model.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, keys)


def calendar_spine(
    df: DataFrame, firm: str, year: str, text_columns: list[str], number_columns: list[str], last_year: int = SPINE_LAST_YEAR
) -> DataFrame:
    """Every firm in every year from the first year of the data to ``last_year``.

    Texts are carried forwards and then backwards within the firm; numbers of added years stay NULL. The
    spine is one generated array per firm, so it costs one shuffle by firm. The columns in use are stored once.
    """
    df = stored(df.select(firm, F.col(year).cast("int").alias(year), *text_columns, *number_columns), "spine")
    first = df.agg(F.min(year).cast("int").alias("y"))
    firms = df.select(firm).distinct()
    spine = firms.select(firm, F.explode(F.sequence(first.scalar(), F.lit(last_year))).alias(year))
    joined = spine.join(df, [firm, year], "left")
    return fill_along(joined, text_columns, [firm], [year])
