"""Importance tables over years or windows: ranking, stability, pivots and linear attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.session import stored


def ranked_features(df: DataFrame, top_n: int | None = None, year: str = "year") -> DataFrame:
    """Adds the rank of each feature within its year (1 = most important, names break ties)."""
    w = Window.partitionBy(year).orderBy(F.col("importance").desc(), "feature")
    ranked = df.withColumn("rank", F.row_number().over(w))
    return ranked if top_n is None else ranked.where(F.col("rank") <= top_n)


def top_mean_features(df: DataFrame, k: int = 15) -> DataFrame:
    """The k features with the highest mean importance over windows (a distributed top-k, no full sort)."""
    means = df.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return means.orderBy(F.col("mean_importance").desc(), "feature").limit(k)


def latest_year_top(df: DataFrame, k: int = 10, year: str = "year") -> DataFrame:
    """The k most important features of the latest year."""
    last = df.agg(F.max(year).alias("y"))
    return df.where(F.col(year) == last.scalar()).orderBy(F.col("importance").desc(), "feature").limit(k)


def top_union(df: DataFrame, top_n: int, year: str = "year") -> DataFrame:
    """Features that reach the top n of any year."""
    return ranked_features(df, top_n, year).select("feature").distinct()


def feature_stability(df: DataFrame, top_n: int = 10, year: str = "year") -> DataFrame:
    """How often, how high and how evenly a feature is among each year's top n."""
    years = df.agg(F.count_distinct(year).alias("n"))
    top = ranked_features(df, top_n, year)
    stats = top.groupBy("feature").agg(
        F.count(F.lit(1)).alias("appearances"),
        F.avg("rank").alias("avg_rank"),
        F.avg("importance").alias("avg_importance"),
        F.stddev_pop("importance").alias("importance_std"),
    )
    out = stats.withColumn("appearance_rate", F.col("appearances") / years.scalar())
    return out.orderBy(F.col("appearance_rate").desc(), F.col("avg_importance").desc(), "feature")


def importance_matrix(df: DataFrame, features: list[str] | None = None, top_n: int | None = None, year: str = "year") -> DataFrame:
    """Year x feature matrix, 0 where a feature has no value. Given names spare the extra pass of the pivot."""
    if top_n is not None:
        df = df.join(top_union(df, top_n, year), "feature", "left_semi")
    return df.groupBy(year).pivot("feature", features).agg(F.first("importance")).fillna(0)


def rank_evolution(df: DataFrame, top_n: int, year: str = "year") -> DataFrame:
    """Rank of every feature of the top-n union in every year; a year without it gives (features of that year + 1)."""
    per_year = df.groupBy(year).agg((F.count(F.lit(1)) + 1).cast("int").alias("last_rank"))
    ranks = ranked_features(df, None, year).select(year, "feature", "rank")
    # Each chosen feature carries the array of years (one entry per year), so the grid needs no cross join.
    years = per_year.agg(F.collect_list(F.struct(year, "last_rank")).alias("ys"))
    grid = top_union(df, top_n, year).select("feature", F.explode(years.scalar()).alias("y"))
    grid = grid.select("feature", F.col(f"y.{year}").alias(year), F.col("y.last_rank").alias("last_rank"))
    return grid.join(ranks, [year, "feature"], "left").select(
        year, "feature", F.coalesce("rank", "last_rank").alias("rank")
    )


def trend_series(df: DataFrame, chosen: DataFrame, year: str = "year") -> DataFrame:
    """Importance of the chosen features per year, in order."""
    return df.join(chosen.select("feature"), "feature", "left_semi").select(year, "feature", "importance").orderBy("feature", year)


def linear_attribution(df: DataFrame, weights: dict[str, float], keys: list[str]) -> DataFrame:
    """Mean absolute attribution per feature and group of a linear score: mean |w_j * (x_j - mean_j)|.

    Both passes stay wide (one column per feature, missing values as 0), so no row is multiplied; only the
    one result row per group is turned into (feature, importance) rows. The means (one row per group) are
    stored first: with their size known, the planner's threshold decides about a broadcast, and rows of a
    large group need not meet in one task.
    """
    features = list(weights)
    x = lambda f: F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    means = stored(df.groupBy(*keys).agg(*[F.avg(x(f)).alias(f"mean_{f}") for f in features]), "means")
    wide = df.join(means, keys).groupBy(*keys).agg(
        *[F.avg(F.abs(F.lit(float(w)) * (x(f) - F.col(f"mean_{f}")))).alias(f) for f, w in weights.items()]
    )
    return wide.unpivot(keys, features, "feature", "importance")
