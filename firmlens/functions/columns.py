"""Column expressions shared by the operators; all of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from firmlens.functions.constants import (
    DATE_TEXT_MISSING,
    DEFAULT,
    EVENT_TEXT,
    EVENT_TEXT_MISSING,
    EVENT_TEXT_OTHER,
)


def blank_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN becomes NULL in floating columns, so that every later null test means "missing"."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    wanted = [c for c in floating if columns is None or c in columns]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in wanted})


def month_of(year: Column | str, month: Column | str) -> Column:
    """First day of a month from its year and month numbers."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.make_date(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1))


def date_from_ints(column: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Date from an integer or text such as 20240131, 202401 (fmt yyyyMM) or 2024-01-31; NULL when it is none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_to_timestamp(column.cast("string"), F.lit(fmt)).cast("date")


def padded_date_text(yy: str, mm: str, dd: str) -> Column:
    """'20yy-mm-dd' text from its numeric parts (two-digit years are filled up with '20')."""
    return F.concat_ws(
        "-",
        F.lpad(F.col(yy).cast("string"), 4, "20"),
        F.lpad(F.col(mm).cast("string"), 2, "0"),
        F.lpad(F.col(dd).cast("string"), 2, "0"),
    )


def _same_day_text(date: Column | str, months: int) -> Column:
    # add_months clamps 31 January to the end of February; an unchanged day tells whether it did.
    date = F.col(date) if isinstance(date, str) else date
    moved = F.add_months(date, months)
    kept = F.dayofmonth(moved) == F.dayofmonth(date)
    return F.coalesce(F.when(kept, F.date_format(moved, "yyyy-MM-dd")), F.lit(DATE_TEXT_MISSING))


def add_one_month_text(date: Column | str) -> Column:
    """Same day one month later as text; a day that does not exist there gives 'N/A'."""
    return _same_day_text(date, 1)


def subtract_one_month_text(date: Column | str) -> Column:
    """Same day one month earlier as text; a day that does not exist there gives 'N/A'."""
    return _same_day_text(date, -1)


def event_description(code: Column | str) -> Column:
    """Text of an event code, given as a number or as text; missing (NULL, NaN) and unlisted codes have their own texts."""
    code = F.col(code) if isinstance(code, str) else code
    written = code.cast("string")
    number = written.try_cast("double")
    text = F.when(written.isNull() | (written == EVENT_TEXT_MISSING), EVENT_TEXT_MISSING)
    for value, name in EVENT_TEXT.items():
        text = text.when(number == value, name)
    return text.otherwise(EVENT_TEXT_OTHER)


def as_default_flag(label: Column | str) -> Column:
    """1 for default, 0 for everything else (exits count as 0)."""
    label = F.col(label) if isinstance(label, str) else label
    return (label == DEFAULT).cast("int")


def argmax_class(probabilities: Column | str) -> Column:
    """Position of the largest probability, the first one on ties."""
    p = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")
