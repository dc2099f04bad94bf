"""Leading labels of a firm-month panel and windows along a firm's months.

The windows partition by firm. A panel holds one row per firm and month, so a partition is as long as the
calendar, whatever share of the raw rows a firm had before it was reduced to months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lead_label(
    df: DataFrame, rows: int, label: str = "Y", firm: list[str] = ("firm",), order: list[str] = ("ym",), name: str | None = None
) -> DataFrame:
    """Label ``rows`` rows ahead per firm; the firm's last rows get NULL."""
    w = Window.partitionBy(*firm).orderBy(*order)
    return df.withColumn(name or label, F.lead(label, rows).over(w))


def lead_label_known(df: DataFrame, rows: int, label: str = "Y", **kwargs) -> DataFrame:
    """As ``lead_label``, rows without a label dropped, label as integer."""
    name = kwargs.get("name") or label
    led = lead_label(df, rows, label, **kwargs)
    return led.where(F.col(name).isNotNull()).withColumn(name, F.col(name).cast("int"))


def lead_label_calendar(
    df: DataFrame, months: int, label: str = "Y", firm: list[str] = ("firm",), month: str = "ym", name: str = "Y_ahead"
) -> DataFrame:
    """Label exactly ``months`` calendar months ahead (NULL when the firm has no row there).

    A range frame of one point on the month number: the same single shuffle by firm as ``lead_label``,
    no self join.
    """
    number = (F.year(month) * 12 + F.month(month)).cast("int")
    w = Window.partitionBy(*firm).orderBy(number).rangeBetween(months, months)
    return df.withColumn(name, F.first(label).over(w))


def fill_along(df: DataFrame, columns: list[str], firm: list[str], order: list[str]) -> DataFrame:
    """Last known value forwards, then the first known value backwards, per firm."""
    w = Window.partitionBy(*firm).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after)) for c in columns}
    )


def rolling_mean(df: DataFrame, column: str, rows: int, partition: list[str], order: list[str], name: str) -> DataFrame:
    """Mean of the last ``rows`` rows, NULL until there are that many."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-(rows - 1), 0)
    full = F.count(column).over(w) == rows
    return df.withColumn(name, F.when(full, F.avg(column).over(w)))


def rolling_sum(df: DataFrame, column: str, rows: int, partition: list[str], order: list[str], name: str) -> DataFrame:
    """Sum of the last ``rows`` rows, NULL until there are that many."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-(rows - 1), 0)
    full = F.count(column).over(w) == rows
    return df.withColumn(name, F.when(full, F.sum(column).over(w)))
