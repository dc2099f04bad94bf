"""Aggregations: latest rows, class counts and weights, window sizes, summaries, data profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.operators.ranges import exact_quantiles
from firmlens.session import stored


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], rows: int = 1) -> DataFrame:
    """The first ``rows`` rows of each key in the given order.

    The rank filter becomes a window group limit before the shuffle, so each task sends at most ``rows``
    rows per key, also for a key that holds a third of all rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_", F.row_number().over(w)).where(F.col("row_") <= rows).drop("row_")


def current_and_previous(df: DataFrame, keys: list[str], day: str, value: str, missing: str = "NaN") -> DataFrame:
    """Most recent and second most recent (day, value) per key as text; a missing previous one is 'NaN'."""
    w = Window.partitionBy(*keys).orderBy(F.col(day).desc(), F.col(value).desc_nulls_last())
    top = df.select(*keys, day, value, F.row_number().over(w).alias("row_")).where(F.col("row_") <= 2)
    pick = lambda c, n: F.max(F.when(F.col("row_") == n, F.coalesce(F.col(c).cast("string"), F.lit(missing))))
    return top.groupBy(*keys).agg(
        pick(day, 1).alias("current_date"),
        pick(value, 1).alias("current_event_type"),
        F.coalesce(pick(day, 2), F.lit(missing)).alias("previous_date"),
        F.coalesce(pick(value, 2), F.lit(missing)).alias("previous_event_type"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def class_counts(df: DataFrame, keys: list[str], label: str = "Y") -> DataFrame:
    """Number of classes and their list per group; the set is over class codes, so it stays tiny."""
    return df.groupBy(*keys).agg(
        F.count_distinct(label).alias("n_classes"),
        F.array_join(F.sort_array(F.collect_set(label)), ",").alias("classes"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def class_weights(df: DataFrame, label: str = "Y", keys: list[str] = ()) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class (per group of ``keys``): at most one row per class and group."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(*keys)
    total, classes = F.sum("n_class").over(w), F.count(F.lit(1)).over(w)
    return counts.select(*keys, label, "n_class", (total / (classes * F.col("n_class"))).alias("weight"))


def weighted_rows(df: DataFrame, label: str = "Y", keys: list[str] = ()) -> DataFrame:
    """Rows with their class's weight.

    The weights (one row per class and group) are stored first, so that the planner knows their size and
    decides by its own threshold whether they can be broadcast instead of shuffling the rows by class.
    """
    weights = stored(class_weights(df, label, keys).select(*keys, label, "weight"), "weights")
    return df.join(weights, [*keys, label], "left")


def series_summary(df: DataFrame, pairs: dict[str, tuple[str, str]], keys: list[str] = ()) -> DataFrame:
    """Mean and sample deviation of both models' metric and their correlation, one column set per metric."""
    aggs = []
    for name, (a, b) in pairs.items():
        aggs += [
            F.avg(a).alias(f"{name}_mean_1"), F.stddev_samp(a).alias(f"{name}_std_1"),
            F.avg(b).alias(f"{name}_mean_2"), F.stddev_samp(b).alias(f"{name}_std_2"),
            F.corr(a, b).alias(f"{name}_corr"),
        ]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dates"), *aggs)


def metric_means(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Means per group; missing values are skipped."""
    return df.groupBy(*keys).agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics])


def window_sizes(per_month: DataFrame, keys: list[str], month: str = "ym") -> DataFrame:
    """Expanding training size next to each month's own counts.

    Works on per-month counts, one row per group and month, never on panel rows.
    """
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    return per_month.withColumn("train_size", F.coalesce(F.sum("n_rows").over(w), F.lit(0)))


def data_profile(df: DataFrame, keys: list[str], columns: list[str], exact: bool = True) -> DataFrame:
    """Per group and column: count, missing, distinct, mean, std, min, quartiles, max as (column, stat, value).

    Exact distinct counts and quartiles come from counts per distinct value placed in value ranges, never
    from a collected set; ``exact=False`` takes fixed-size sketches and spares that shuffle.
    """
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(keys, columns, "column", "x")
    by = [*keys, "column"]
    simple = [
        F.count("x").cast("double").alias("count"),
        F.count_if(F.col("x").isNull()).cast("double").alias("missing"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    ]
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    if exact:
        quartiles = exact_quantiles(long, by, "x", shares, distinct="distinct")
        stats = long.groupBy(*by).agg(*simple).join(quartiles, by, "left")
    else:
        sketches = [F.percentile_approx("x", q).alias(n) for n, q in shares.items()]
        stats = long.groupBy(*by).agg(*simple, F.approx_count_distinct("x", 0.01).cast("double").alias("distinct"), *sketches)
    names = ["count", "missing", "distinct", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return stats.fillna(0.0, subset=["distinct"]).unpivot(by, names, "stat", "value")


def profile_parts(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per (keys, column) of what a profile of any union of groups can be merged from; keep it as a table.

    Counts, sums of squares around the group's mean, extremes, a KLL sketch of the values and an HLL sketch of the
    distinct ones: a few kilobytes per group, whatever its size. Rows are reduced in their tasks before any shuffle.
    """
    long = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns]).unpivot(keys, columns, "column", "x")
    return long.groupBy(*keys, "column").agg(
        F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("missing"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance"),
        F.min("x").alias("min"), F.max("x").alias("max"), F.kll_sketch_agg_double("x", 400).alias("values"), F.hll_sketch_agg(F.col("x").cast("string"), 14).alias("distinct"),
    )


def merged_profile(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``data_profile`` of the groups ``keys`` from stored ``profile_parts`` of smaller ones; no row is read again.

    Count, missing, mean, std, min and max are exact. Quartiles lie within 1 % in rank and distinct counts within 2.5 %, the
    errors of the sketches at three standard deviations.
    """
    by = [*keys, "column"]
    group = Window.partitionBy(*by)
    centre = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    spread = F.col("n") * (F.col("variance") + (F.col("mean") - F.col("centre")) ** 2)
    filled = F.col("n") > 0  # a group without values has empty sketches
    merged = parts.withColumn("centre", centre).groupBy(*by).agg(
        F.sum("n").cast("double").alias("count"), F.sum("missing").cast("double").alias("missing"), F.max("centre").alias("mean"), F.sum(spread).alias("squares"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double(F.when(filled, F.col("values"))).alias("values"), F.hll_union_agg(F.when(filled, F.col("distinct"))).alias("distinct"),
    )
    some = F.col("count") > 0
    quartile = lambda q: F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(q)))
    stats = merged.select(
        *by, "count", "missing", F.when(some, F.hll_sketch_estimate("distinct")).otherwise(0).cast("double").alias("distinct"), "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"), "min",
        quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75"), "max",
    )
    names = ["count", "missing", "distinct", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return stats.unpivot(by, names, "stat", "value")
