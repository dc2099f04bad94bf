"""Panel preparation: fills, filters, dates, projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.columns import add_one_month_text, blank_to_null
from firmlens.functions.constants import (
    COVARIATES,
    DEFAULT,
    FINANCIAL_COVARIATES,
    UNKNOWN_OUTCOME,
    UNUSABLE_LABEL,
)


def fill_financial(df: DataFrame, columns: list[str] = FINANCIAL_COVARIATES) -> DataFrame:
    """Covariates that only financial firms have are 0 for all others."""
    return df.fillna(0, subset=columns)


def fill_defaulted(df: DataFrame, label: str = "Y", keep: list[str] = ()) -> DataFrame:
    """Rows that default: every missing number becomes 0.

    This uses the (future) label and so cannot be repeated at scoring time; it is here for parity and is
    not part of the default preparation.
    """
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    columns = [c for c, t in df.dtypes if t in numeric and c != label and c not in keep]
    # Same branch types keep the column's own type.
    return df.withColumns(
        {c: F.when(F.col(label) == DEFAULT, F.coalesce(c, F.lit(0))).otherwise(F.col(c)) for c in columns}
    )


def drop_unusable(df: DataFrame, label: str = "Y", sentinel: int = UNUSABLE_LABEL) -> DataFrame:
    """Drops sentinel labels; rows with a missing label stay."""
    return df.where(F.col(label).isNull() | (F.col(label) != sentinel))


def known_outcomes(df: DataFrame, label: str, unknown: int = UNKNOWN_OUTCOME) -> DataFrame:
    """Rows whose outcome is known by now."""
    return df.where(F.col(label) != unknown)


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """Rows with all of these columns present (NaN counts as missing)."""
    return blank_to_null(df, subset).dropna(subset=subset)


def feature_columns(df: DataFrame, not_features: list[str], fixed: bool = False) -> list[str]:
    """Feature names: the fixed covariate list, or every column that is not a key, date or target.

    With the fixed list all of it must be there: a model is never fitted on fewer inputs without notice.
    """
    if fixed:
        if missing := [c for c in COVARIATES if c not in df.columns]:
            raise ValueError(f"covariates are missing: {missing}")
        return list(COVARIATES)
    return [c for c in df.columns if c not in not_features]


def renamed_predictions(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keeps and renames exactly these columns."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def stamped(df: DataFrame, **constants) -> DataFrame:
    """Adds constant columns (econ, horizon, task_date ...); dates are passed in, never taken from the clock."""
    return df.withColumns({name: value if isinstance(value, Column) else F.lit(value) for name, value in constants.items()})


def with_forecast_date(df: DataFrame, date: str = "yyyymmdd", name: str = "forecast_date") -> DataFrame:
    """Adds the same day of the next month as text."""
    return df.withColumn(name, add_one_month_text(date))


def search_text(df: DataFrame, text: str | None, columns: list[str], regex: bool = False) -> DataFrame:
    """Rows in which any of the columns contains the text, whatever its case; a missing value never matches."""
    if not text:
        return df
    if regex:
        hits = [F.col(c).rlike("(?i)" + text) for c in columns]
    else:
        hits = [F.contains(F.lower(c), F.lit(text.lower())) for c in columns]
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits]))


def scored_series(df: DataFrame, econ, horizon: int) -> DataFrame:
    """Backtest rows of one economy and horizon with at least one metric, by date."""
    return (
        df.where((F.col("econ") == econ) & (F.col("horizon") == horizon))
        .where(F.col("auc_score").isNotNull() | F.col("pr_auc").isNotNull())
        .orderBy("date")
    )
