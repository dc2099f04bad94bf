"""Exact ranking measures of a score against a 0/1 label, for any number of groups in one job.

Rows are first counted per (group, distinct score); everything after that works on counts. Groups of any
size are handled through value ranges (see ``ranges``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.operators.ranges import (
    BUCKET,
    cumulate,
    quantile_cuts,
    range_starts,
    running_totals,
    stack_with_starts,
    with_bucket,
    with_next,
)
from firmlens.operators.splits import window_starts
from firmlens.session import stored


def score_counts(df: DataFrame, keys: list[str], label: str, score: str, weight: str | None = None) -> DataFrame:
    """(keys, score, npos, nneg): label counts per distinct score; rows without label or score are left out."""
    one = F.col(weight) if weight else F.lit(1)
    return (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
        .groupBy(*keys, F.col(score).alias("score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, one).otherwise(0)).alias("npos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(one)).alias("nneg"),
        )
    )


def counts_and_cuts(
    df: DataFrame, keys: list[str], label: str, score: str, cuts: list[float] | None
) -> tuple[DataFrame, list[float]]:
    """Score counts and the cut points for them.

    Without given cuts the counts are stored first: the rows behind them (often joins or a model) are then
    evaluated once, and the cuts balance the distinct scores that are actually shuffled.
    """
    cells = score_counts(df, keys, label, score)
    if cuts is None:
        cells = stored(cells, "score_counts")
        cuts = quantile_cuts(cells, "score")
    return cells, cuts


def auc_from_counts(cells: DataFrame, keys: list[str], cuts: list[float]) -> DataFrame:
    """(keys, n_pos, n_neg, auc) from score counts; AUC is NULL when one class is missing.

    The pairs won are split into those inside a range and those between ranges; both are sums, so the
    cells are shuffled once by (group, range) and only range totals move after that.
    """
    inside = Window.partitionBy(*keys, BUCKET).orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cells = with_bucket(cells, "score", cuts).withColumn("ctp", F.sum("npos").over(inside))
    ranges = cells.groupBy(*keys, BUCKET).agg(
        F.sum(F.col("nneg").cast("double") * (F.col("ctp") - F.col("npos") / 2)).alias("won"),
        F.sum("npos").alias("npos"),
        F.sum("nneg").alias("nneg"),
    )
    higher = Window.partitionBy(*keys).orderBy(F.col(BUCKET).desc()).rowsBetween(Window.unboundedPreceding, -1)
    crossed = ranges.withColumn(
        "won", F.col("won") + F.col("nneg") * F.coalesce(F.sum("npos").over(higher), F.lit(0)).cast("double")
    )
    sums = crossed.groupBy(*keys).agg(
        F.sum("npos").alias("n_pos"), F.sum("nneg").alias("n_neg"), F.sum("won").alias("won")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(*keys, "n_pos", "n_neg", F.when(pairs > 0, F.col("won") / pairs).alias("auc"))


def roc_auc(df: DataFrame, keys: list[str], label: str, score: str, cuts: list[float] | None = None) -> DataFrame:
    """Exact ROC-AUC with ties per group."""
    cells, cuts = counts_and_cuts(df, keys, label, score, cuts)
    return auc_from_counts(cells, keys, cuts)


SUMS = ["npos", "nneg"]


def as_points(placed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per distinct score with the counts at and above it (ctp, cfp) and the group's totals."""
    return placed.select(
        *keys, "score", *SUMS,
        (F.col("before_npos") + F.col("npos")).alias("ctp"),
        (F.col("before_nneg") + F.col("nneg")).alias("cfp"),
        F.col("all_npos").alias("n_pos"),
        F.col("all_nneg").alias("n_neg"),
    )


def threshold_points(cells: DataFrame, keys: list[str], cuts: list[float]) -> DataFrame:
    """Points of score counts per (keys, score)."""
    ranged = with_bucket(cells, "score", cuts).select(*keys, BUCKET, "score", *SUMS)
    return as_points(running_totals(ranged, keys, "score", SUMS, descending=True), keys)


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


def roc_curve(df: DataFrame, keys: list[str], label: str, score: str, cuts: list[float] | None = None, drop_collinear: bool = False) -> DataFrame:
    """(keys, threshold, fpr, tpr), one point per distinct score; the (0, 0) start is implied.

    ``drop_collinear`` leaves out points at which the curve goes on exactly as it came: a point stays if it is the first or last
    of its group, or if the next score adds other counts than its own did.
    """
    cells, cuts = counts_and_cuts(df, keys, label, score, cuts)
    if drop_collinear:
        ranged = with_next(with_bucket(cells, "score", cuts).select(*keys, BUCKET, "score", *SUMS), keys, "score", SUMS, descending=True)
        placed = running_totals(ranged, keys, "score", SUMS, descending=True)
        first = (F.col("before_npos") == 0) & (F.col("before_nneg") == 0)
        turns = (F.col("npos") != F.col("next_npos")) | (F.col("nneg") != F.col("next_nneg"))
        points = as_points(placed.where(first | F.col("next_npos").isNull() | turns), keys)
    else:
        points = threshold_points(cells, keys, cuts)
    return points.select(*keys, F.col("score").alias("threshold"), _share("cfp", "n_neg").alias("fpr"), _share("ctp", "n_pos").alias("tpr"))


def roc_curves_of_two(df: DataFrame, keys: list[str], model: str, current: str, reference: str, label: str, score: str) -> DataFrame:
    """(keys, threshold, fpr_current, tpr_current, fpr_reference, tpr_reference) at every score of either model.

    Where a model has no score of its own its last point holds. Both models' counts lie in one cell per (keys, score), so
    running totals over the common axis carry them there, range by range. A model without rows of a class has NULL shares.
    """
    sums = [f"{side}_{kind}" for side in ("cur", "ref") for kind in ("pos", "neg")]
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score) & F.col(model).isin(current, reference))
    hit = lambda name, positive: F.count_if((F.col(model) == name) & ((F.col(label) == 1) if positive else (F.col(label) != 1)))
    counts = [hit(name, positive).alias(c) for c, (name, positive) in zip(sums, [(current, True), (current, False), (reference, True), (reference, False)])]
    cells = stored(known.groupBy(*keys, F.col(score).alias("score")).agg(*counts), "two_models")
    ranged = with_bucket(cells, "score", quantile_cuts(cells, "score")).select(*keys, BUCKET, "score", *sums)
    placed = running_totals(ranged, keys, "score", sums, descending=True)
    share = lambda c: F.when(F.col(f"all_{c}") > 0, (F.col(f"before_{c}") + F.col(c)) / F.col(f"all_{c}"))
    return placed.select(
        *keys, F.col("score").alias("threshold"), share("cur_neg").alias("fpr_current"), share("cur_pos").alias("tpr_current"),
        share("ref_neg").alias("fpr_reference"), share("ref_pos").alias("tpr_reference"),
    )


def pr_curve(df: DataFrame, keys: list[str], label: str, score: str, cuts: list[float] | None = None) -> DataFrame:
    """(keys, threshold, prec, rec), one point per distinct score; recall is 1 throughout without positives."""
    cells, cuts = counts_and_cuts(df, keys, label, score, cuts)
    points = threshold_points(cells, keys, cuts)
    return points.select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("ctp") / (F.col("ctp") + F.col("cfp"))).alias("prec"),
        F.when(F.col("n_pos") > 0, F.col("ctp") / F.col("n_pos")).otherwise(F.lit(1.0)).alias("rec"),
    )


def ranking_of_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_pos, n_neg, auc, pr_auc) from threshold points.

    PR-AUC is the trapezoid over the points, anchored at recall 0 and precision 1; a point's predecessor
    is the point minus its own counts, so no lag across ranges is needed. Without positives it is 0.5.
    """
    seen = F.col("ctp") + F.col("cfp")
    earlier = seen - F.col("npos") - F.col("nneg")
    prec_before = F.when(earlier > 0, (F.col("ctp") - F.col("npos")) / earlier).otherwise(F.lit(1.0))
    sums = points.groupBy(*keys).agg(
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        F.sum(F.col("nneg").cast("double") * (F.col("ctp") - F.col("npos") / 2)).alias("won"),
        F.sum(F.col("npos") * (F.col("ctp") / seen + prec_before) / 2).alias("area"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(
        *keys, "n_pos", "n_neg",
        F.when(pairs > 0, F.col("won") / pairs).alias("auc"),
        F.when(F.col("n_pos") > 0, F.col("area") / F.col("n_pos")).otherwise(F.lit(0.5)).alias("pr_auc"),
    )


def ranking_measures(df: DataFrame, keys: list[str], label: str, score: str, cuts: list[float] | None = None) -> DataFrame:
    """ROC-AUC and PR-AUC per group."""
    cells, cuts = counts_and_cuts(df, keys, label, score, cuts)
    return ranking_of_points(threshold_points(cells, keys, cuts), keys)


def ranking_of_counts(cells: DataFrame, keys: list[str], cuts: list[float] | None = None) -> DataFrame:
    """ROC-AUC and PR-AUC per group from stored label counts (keys, score, npos, nneg), one row per distinct score."""
    if cuts is None:
        cuts = quantile_cuts(cells, "score")
    return ranking_of_points(threshold_points(cells, keys, cuts), keys)


def ranking_over_windows(
    monthly: DataFrame, keys: list[str], cuts: list[float], span: int, start: date, end: date, month: str = "ym",
) -> DataFrame:
    """ROC-AUC and PR-AUC of every window [w, w + span months) from score counts per (keys, month, score).

    Counts and the start rows of all windows' ranges are shuffled together, once, by (keys, range). Only then
    are counts repeated over the windows they lie in: adding them up and the running totals per (keys, window,
    range) keep that partitioning, so repeated rows never leave their task. The range totals behind the start
    rows are repeated over windows on their own, after they are down to one row per (keys, month, range).
    """
    by = [*keys, "window"]
    add = [F.sum(c).alias(c) for c in SUMS]
    cells = with_bucket(monthly, "score", cuts)
    per_range = cells.groupBy(*keys, month, BUCKET).agg(*add)
    totals = window_starts(per_range, span, start, end, month).groupBy(*by, BUCKET).agg(*add)
    starts = range_starts(totals, by, SUMS, descending=True).withColumnRenamed("window", month)
    stacked = stack_with_starts(cells.select(*keys, month, BUCKET, "score", *SUMS), starts, "score", SUMS)
    placed = stacked.repartition(*keys, BUCKET)
    # A start row already is at its window; a count is in the windows of the last ``span`` months.
    repeated = window_starts(placed, F.when(F.col("kind_") == 1, span).otherwise(1), start, end, month)
    merged = repeated.groupBy(*by, BUCKET, "kind_", "score").agg(*add, *[F.max(f"all_{c}").alias(f"all_{c}") for c in SUMS])
    return ranking_of_points(as_points(cumulate(merged, by, "score", SUMS, descending=True), by), by)
