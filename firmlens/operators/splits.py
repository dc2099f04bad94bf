"""Time-ordered splits. Rows are tagged; no list of frames is built."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmlens.session import stored

from firmlens.operators.ranges import BUCKET, quantile_cuts, with_bucket


def month_calendar(spark: SparkSession, start: date, end: date, step_months: int = 1, name: str = "window") -> DataFrame:
    """Month starts from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.make_ym_interval(F.lit(0), F.lit(step_months)))
    return spark.range(1).select(F.explode(days).alias(name))


def holdout_years(df: DataFrame, year: str = "year", test_years: int = 3) -> DataFrame:
    """Adds ``role``: 'test' for the last ``test_years`` distinct years of the data, else 'train'.

    The years are ranked among themselves (one row per year); the resulting cut year is a scalar, so the
    panel itself is neither shuffled nor joined.
    """
    last = df.select(year).distinct().orderBy(F.col(year).desc()).limit(test_years)
    first_test = last.agg(F.min(year).alias("y"))
    return df.withColumn("role", F.when(F.col(year) >= first_test.scalar(), "test").otherwise("train"))


def year_split(df: DataFrame, test_year: int, year: str = "year") -> DataFrame:
    """'test' = the year, 'train' = the years before; later rows belong to neither and are dropped."""
    role = F.when(F.col(year) == test_year, "test").when(F.col(year) < test_year, "train")
    return df.withColumn("role", role).where(F.col("role").isNotNull())


def month_split(df: DataFrame, test_month: date, month: str = "ym") -> DataFrame:
    """'test' = the month, 'train' = before its first day; later rows are dropped."""
    role = F.when(F.col(month) == F.lit(test_month), "test").when(F.col(month) < F.lit(test_month), "train")
    return df.withColumn("role", role).where(F.col("role").isNotNull())


def block_borders(
    df: DataFrame, n_splits: int, day: str, tie: str, cuts: list[float] | None = None
) -> list[tuple]:
    """First (day, tie) of blocks 1..n in (day, tie) order; (day, tie) must be a key of the rows.

    Rows are counted per (day, range of the tie key), which tells the cell every border falls into; only
    those cells (at most ``n_splits``, each about a 1/parts share of a day) are then numbered row by row.
    """
    keys = df.select(day, tie)
    if cuts is None:
        cuts = quantile_cuts(keys, tie)
    keys = with_bucket(keys, tie, cuts)
    cells = keys.groupBy(day, BUCKET).agg(F.count(F.lit(1)).alias("n"))
    over_days = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)  # one row per day
    days = cells.groupBy(day).agg(F.sum("n").alias("n_day")).select(
        day,
        F.coalesce(F.sum("n_day").over(over_days), F.lit(0)).alias("day_start"),
        F.sum("n_day").over(Window.partitionBy(F.lit(1))).alias("total"),
    )
    in_day = Window.partitionBy(day).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("day_start") + F.coalesce(F.sum("n").over(in_day), F.lit(0))
    placed = cells.join(days, day).select(day, BUCKET, "n", "total", start.alias("start"))
    size = F.floor(F.col("total") / (n_splits + 1))
    border = F.col("total") - (n_splits + 1 - F.col("block")) * size
    found = (
        placed.withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
        .select("block", day, BUCKET, "start", "n", border.alias("border"))
        .where((F.col("start") <= F.col("border")) & (F.col("border") < F.col("start") + F.col("n")))
        .collect()
    )
    if not found:
        return []
    at_cell = lambda r: (F.col(day) == F.lit(r[day])) & (F.col(BUCKET) == r[BUCKET])
    in_cell = Window.partitionBy(day, BUCKET).orderBy(tie)
    numbered = keys.where(reduce(or_, [at_cell(r) for r in found])).withColumn("i", F.row_number().over(in_cell))
    wanted = [at_cell(r) & (F.col("i") == r["border"] - r["start"] + 1) for r in found]
    return sorted(tuple(r) for r in numbered.where(reduce(or_, wanted)).select(day, tie).collect())


def expanding_blocks(
    df: DataFrame, n_splits: int = 5, day: str = "ym", tie: str = "firm", cuts: list[float] | None = None
) -> DataFrame:
    """Adds ``block`` 0..n: fold f validates the rows of block f and trains on all blocks before it.

    Blocks are equal row counts in (day, tie) order with the remainder in block 0. Once the ``n_splits``
    borders are known, the block of a row is a comparison: rows are neither shuffled nor joined.
    """
    reached = [
        ((F.col(day) > F.lit(d)) | ((F.col(day) == F.lit(d)) & (F.col(tie) >= F.lit(t)))).cast("int")
        for d, t in block_borders(df, n_splits, day, tie, cuts)
    ]
    return df.withColumn("block", reduce(add, reached, F.lit(0)))


def fold_roles(df: DataFrame, n_splits: int = 5) -> DataFrame:
    """Per-block aggregates or rows repeated as (fold, role): block b validates fold b and trains folds after it."""
    folds = F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(n_splits))
    out = df.withColumn("fold", F.explode(folds))
    return out.withColumn("role", F.when(F.col("fold") == F.col("block"), "val").otherwise("train"))


def fold_ranges(blocks: DataFrame, n_splits: int = 5, day: str = "ym") -> DataFrame:
    """First and last day, first and last row number and size of every fold's two parts.

    Blocks are reduced to one row each before they are repeated over folds.
    """
    per_block = blocks.groupBy("block").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n")
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # n_splits + 1 rows
    per_block = per_block.withColumn("first_row", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return fold_roles(per_block, n_splits).groupBy("fold", "role").agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.min("first_row").alias("first_row"),
        F.max(F.col("first_row") + F.col("n") - 1).alias("last_row"),
        F.sum("n").alias("n_rows"),
    )


def window_starts(df: DataFrame, span: int | Column, start: date, end: date, month: str = "ym", name: str = "window") -> DataFrame:
    """Repeats each row for every window [w, w + span months) it lies in, w a month start in [start, end].

    ``span`` may be a column, for frames whose rows reach differently far.

    The range condition is written as ``span`` month offsets per row, so what follows is a plain group-by
    or hash join on the window; no nested loop. Feed it counts rather than rows where possible.
    """
    offsets = F.sequence(F.lit(0), (span if isinstance(span, Column) else F.lit(span)) - 1)
    repeated = df.withColumn("off_", F.explode(offsets))
    repeated = repeated.withColumn(name, F.expr(f"add_months({month}, -off_)")).drop("off_")
    return repeated.where(F.col(name).between(F.lit(start), F.lit(end)))


def window_roles(df: DataFrame, calendar: DataFrame, span: int, month: str = "ym", name: str = "window") -> DataFrame:
    """Rows of each window's test part, by an equi join on the calendar's month starts (span 1: month = window)."""
    if span == 1:
        return df.join(calendar, F.col(month) == F.col(name))
    offsets = F.sequence(F.lit(0), F.lit(span - 1))
    repeated = df.withColumn("off_", F.explode(offsets)).withColumn(name, F.expr(f"add_months({month}, -off_)"))
    return repeated.drop("off_").join(calendar, name)


def class_count_columns(label: str = "Y") -> list[Column]:
    """Counts per class as aggregate columns n_rows, n0, n1, n2."""
    return [F.count(F.lit(1)).alias("n_rows")] + [F.count_if(F.col(label) == c).alias(f"n{c}") for c in (0, 1, 2)]


def window_class_counts(
    df: DataFrame, keys: list[str], span: int, start: date, end: date, label: str = "Y", month: str = "ym",
) -> DataFrame:
    """Per window: train and test sizes and class counts; the panel is aggregated once to (keys, month)."""
    # A few rows per group, which several branches read.
    monthly = stored(df.groupBy(*keys, month).agg(*class_count_columns(label)), "monthly")
    return window_counts_from_monthly(monthly, keys, span, start, end, month)


def window_counts_from_monthly(
    monthly: DataFrame, keys: list[str], span: int, start: date, end: date, month: str = "ym",
) -> DataFrame:
    """Window counts from class counts per (keys, month): one row per group and month, whatever the panel's size.

    Expanding train counts are a running sum over months.
    """
    spark = monthly.sparkSession
    counts = ["n_rows", "n0", "n1", "n2"]
    test = window_starts(monthly, span, start, end, month).groupBy(*keys, "window").agg(
        *[F.sum(c).alias(f"test_{c}") for c in counts]
    )
    # Every group gets every window, also one without rows: a generated array per group, no join.
    days = F.sequence(F.lit(start), F.lit(end), F.make_ym_interval(F.lit(0), F.lit(1)))
    groups = monthly.select(*keys).distinct() if keys else spark.range(1)
    grid = groups.select(*keys, F.explode(days).alias("window"))
    # Train counts: months and windows are stacked and cumulated together in date order.
    stacked = monthly.select(*keys, F.col(month).alias("at"), F.lit(1).alias("kind"), *counts).unionByName(
        grid.select(*keys, F.col("window").alias("at"), F.lit(0).alias("kind"), *[F.lit(0).cast("long").alias(c) for c in counts])
    )
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    train = stacked.withColumns({f"train_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in counts}).where("kind = 0")
    train = train.select(*keys, F.col("at").alias("window"), *[f"train_{c}" for c in counts])
    both = train.join(test, [*keys, "window"], "left")
    return both.fillna(0, subset=[f"test_{c}" for c in counts])


def with_window_status(counts: DataFrame) -> DataFrame:
    """Adds ``status`` of a window from its class counts, in the order the checks are made."""
    classes = lambda part: sum((F.col(f"{part}_n{c}") > 0).cast("int") for c in (0, 1, 2))
    status = (
        F.when((F.col("test_n_rows") == 0) | (F.col("train_n_rows") == 0), "no_rows")
        .when(classes("train") < 2, "one_train_class")
        .when(classes("test") < 2, "one_test_class")
        .when(F.col("test_n0") + F.col("test_n1") == 0, "exits_only")
        .otherwise("scored")
    )
    return counts.withColumn("status", status)
