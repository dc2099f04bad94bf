"""Expanding-window backtests: the relational core, and the driver of window fits."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor, as_completed
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.constants import EXIT
from firmlens.operators.ranges import quantile_cuts
from firmlens.operators.scores import counts_and_cuts, ranking_over_windows
from firmlens.operators.splits import (
    class_count_columns,
    window_class_counts,
    window_counts_from_monthly,
    with_window_status,
)
from firmlens.plans.learn import PARALLEL_FITS, Learner, fit, in_parallel, learner_from, score, with_predictions
from firmlens.session import scratch_path, stored
from firmlens.sources.sinks import groups_to_run, insert_ignore, read_if_exists


def backtest_table(sizes: DataFrame, ranking: DataFrame, keys: list[str]) -> DataFrame:
    """Result rows of a backtest from window class counts and window ranking measures.

    Scored windows carry their measures; a window whose training part has one class keeps the row with no
    AUC, PR-AUC 0.5 and 0 positives; the other skipped windows have no row.
    """
    status = with_window_status(sizes)
    rows = status.join(ranking.select(*keys, "window", "auc", "pr_auc"), [*keys, "window"], "left")
    scored = F.col("status") == "scored"
    return rows.where(F.col("status").isin("scored", "one_train_class")).select(
        *keys,
        F.col("window").alias("date"),
        F.when(scored, F.col("auc")).alias("auc_score"),
        F.when(scored, F.col("pr_auc")).otherwise(F.lit(0.5)).alias("pr_auc"),
        F.col("train_n_rows").alias("train_size"),
        F.col("test_n_rows").alias("test_size"),
        F.when(scored, F.col("test_n1")).otherwise(F.lit(0)).alias("test_positives"),
        F.when(scored, F.col("test_n0") + F.col("test_n1")).alias("test_samples"),
    )


def relational_backtest(df: DataFrame, keys: list[str], start: date, end: date, span: int = 12, label: str = "Y",
                        score: str = "score", month: str = "ym", cuts: list[float] | None = None) -> DataFrame:
    """Whole backtest table of a stored score: windows, guards, sizes and measures of all groups in one job.

    The rows are read once, into class counts per (keys, month, score). Window sizes, guards and the ranking
    measures (default against none, exits left out) are all taken from that table, which is stored because
    three branches read it and its score distribution gives the cut points. Rows without a score (NULL or NaN)
    take no part at all: they leave the sizes too.
    """
    cells = df.where(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(*keys, month, F.col(score).alias("score")).agg(*class_count_columns(label))
    if cuts is None:
        cells = stored(cells, "backtest_counts")
        cuts = quantile_cuts(cells, "score")
    labelled = cells.where("n0 + n1 > 0").select(*keys, month, "score", F.col("n1").alias("npos"), F.col("n0").alias("nneg"))
    ranking = ranking_over_windows(labelled, keys, cuts, span, start, end, month)
    counts = ["n_rows", "n0", "n1", "n2"]
    monthly = cells.groupBy(*keys, month).agg(*[F.sum(c).alias(c) for c in counts])
    return backtest_table(window_counts_from_monthly(monthly, keys, span, start, end, month), ranking, keys)


def refit_units(units: list[tuple], refit_every: int) -> dict[tuple, list[date]]:
    """(key values and fit month) -> the windows that this fit scores: its own and those before the next fit."""
    out: dict[tuple, list[date]] = {}
    for *keys, window in sorted(units):
        last = next(reversed(out), None)
        months = (window.year - last[-1].year) * 12 + window.month - last[-1].month if last and last[:-1] == tuple(keys) else refit_every
        if months >= refit_every:
            last = (*keys, window)
            out[last] = []
        out[last].append(window)
    return out


def scored_months(
    table: DataFrame, features: list[str], units: list[tuple], span: int, learner: Learner, keys: list[str] = (),
    label: str = "Y", month: str = "ym", path: str | None = None, refit_every: int = 1, workers: int = PARALLEL_FITS,
) -> tuple[DataFrame | None, list[tuple]]:
    """Scores every row that a window of ``units`` (key values and window start) holds, once per fit, with a model of the months before.

    Returns (stored rows, [(key values and fit month, model)]); a stored row has the keys, ``fit``, month, y, p1 and yhat. With
    ``refit_every`` above 1 a model also scores the windows that start less than that many months after its own, so every window
    is scored by a model that has seen nothing of it. ``table`` comes from ``training_table`` (one folder per month), so a unit reads
    its own months only. Predictions and model of a fit are written to folders of their own: a restart with the same ``path`` fits
    what is missing and loads the other models, so it returns all of them. Fits go through one small pool of job
    submissions. Units to skip must have been left out by the guards.
    """
    spark = table.sparkSession
    path = path or scratch_path(spark, "predictions")
    names = [*keys, "fit"]
    stored = read_if_exists(spark, path)
    done = set() if stored is None else {tuple(str(v) for v in r) for r in stored.select(*names).distinct().collect()}

    def run(unit: tuple, windows: list[date]):
        place = "/".join(f"{name}={value}" for name, value in zip(names, unit))
        if tuple(map(str, unit)) in done:
            return unit, PipelineModel.load(f"{path}_models/{place}")
        rows = table
        for key, value in zip(keys, unit):
            rows = rows.where(F.col(key) == value)
        at = F.col(month)
        test = rows.where((at >= F.lit(windows[0])) & (at < F.add_months(F.lit(windows[-1]), span)))
        model = fit(rows.where(at < F.lit(unit[-1])), features, learner, label)
        model.write().overwrite().save(f"{path}_models/{place}")
        with_predictions(score(model, test), label).select(month, "y", "p1", "yhat").write.mode("overwrite").parquet(f"{path}/{place}")
        return unit, model

    fits = refit_units(units, refit_every)
    models = in_parallel(spark, [lambda u=u, w=w: run(u, w) for u, w in fits.items()], workers)
    return read_if_exists(spark, path), models


def fits_of_windows(table: DataFrame, units: list[tuple], refit_every: int, keys: list[str]) -> DataFrame:
    """(keys, window, fit): the fit that scores each window; one row per window."""
    rows = [(*unit[:-1], window, unit[-1]) for unit, windows in refit_units(units, refit_every).items() for window in windows]
    schema = ", ".join([*(f"`{k}` {table.schema[k].dataType.simpleString()}" for k in keys), "window date, fit date"])
    return table.sparkSession.createDataFrame(rows, schema)


def fitted_predictions(
    table: DataFrame, features: list[str], units: list[tuple], span: int, learner: Learner, keys: list[str] = (),
    label: str = "Y", month: str = "ym", path: str | None = None, refit_every: int = 1, workers: int = PARALLEL_FITS,
) -> tuple[DataFrame | None, list[tuple]]:
    """``scored_months`` with every row in each ``window`` that it lies in; rows are repeated when they are read, not in the store."""
    scored, models = scored_months(table, features, units, span, learner, keys, label, month, path, refit_every, workers)
    if scored is None:
        return None, models
    keys, at = list(keys), F.col(month)
    windows = fits_of_windows(table, units, refit_every, keys).groupBy(*keys, "fit").agg(F.collect_list("window").alias("windows"))
    inside = lambda w: (at >= w) & (at < F.add_months(w, span))
    return scored.join(windows, [*keys, "fit"]).withColumn("window", F.explode(F.filter("windows", inside))).drop("windows"), models


def fitted_backtest(
    table: DataFrame, features: list[str], start: date, end: date, span: int, learner: Learner, keys: list[str] = (),
    label: str = "Y", month: str = "ym", step_months: int = 1, path: str | None = None, refit_every: int = 1,
    workers: int = PARALLEL_FITS,
) -> tuple[DataFrame, list[tuple]]:
    """Backtest table of every ``step_months``-th window start, the model refitted every ``refit_every`` months (per group of ``keys``).

    ``train_size`` counts what lies before a window; ``fit`` is the month up to which the window's model has seen rows and
    ``fitted_rows`` their number, both NULL for windows that no model scores. The guards of all windows and groups are decided before any fit, by one aggregation over (keys, month,
    class); the measures of all windows and groups come from one job over the stored predictions.
    """
    keys = list(keys)
    on_step = F.months_between(F.col("window"), F.lit(start)).cast("int") % step_months == 0
    sizes = stored(window_class_counts(table, keys, span, start, end, label, month).where(on_step), "sizes")
    # One row per group and window: metadata that decides which fits are submitted.
    status = with_window_status(sizes).where("status = 'scored'").select(*keys, "window")
    units = sorted(tuple(r) for r in status.collect())
    scored, models = scored_months(table, features, units, span, learner, keys, label, month, path, refit_every, workers)
    fits = fits_of_windows(table, units, refit_every, keys)
    if scored is None or not units:
        none = F.lit(None).cast("double")
        ranking = sizes.select(*keys, "window", none.alias("auc"), none.alias("pr_auc")).limit(0)
    else:
        # Counts per month and distinct score; only these are repeated over windows, and only for measures of a window's own fit.
        by, months = [*keys, "fit"], [unit[-1] for unit in units]
        cells, cuts = counts_and_cuts(scored.where(F.col("y") != EXIT), [*by, month], "y", "p1", None)
        ranking = ranking_over_windows(cells, by, cuts, span, min(months), max(months), month).join(fits, [*by, "window"])
    seen = sizes.select(*keys, F.col("window").alias("fit"), F.col("train_n_rows").alias("fitted_rows"))
    fitted = fits.withColumnRenamed("window", "date").join(seen, [*keys, "fit"])
    return backtest_table(sizes, ranking, keys).join(fitted, [*keys, "date"], "left"), models


def backtest_economies(
    table: DataFrame, features: list[str], start: date, end: date, span: int, learner: Learner, results: str, stamp: date,
    label: str = "Y", month: str = "ym", step_months: int = 1, horizon: int = 12, refit_every: int = 1,
    settings: dict | None = None, workers: int = PARALLEL_FITS,
) -> DataFrame:
    """Backtest of every economy that has no stored result for this horizon; rows are stored, then returned.

    Economies run a few at a time and are stored one by one as they finish, keyed by (econ, horizon, date); predictions
    and models lie beside the results, so a restarted run goes on where it stopped, within an economy too. ``settings``
    gives an economy's own tuned settings (text, as a search stores them).
    """
    spark = table.sparkSession
    economies = table.select("econ").distinct()
    todo = sorted(r["econ"] for r in groups_to_run(economies, read_if_exists(spark, results), "econ", horizon).collect())
    # One folder per economy: each of its many jobs reads its own rows instead of all, and months by the files' statistics.
    place = scratch_path(spark, "by_economy")
    table.hint("rebalance", "econ").sortWithinPartitions("econ", month).write.partitionBy("econ").parquet(place)
    table = spark.read.schema(table.schema).parquet(place)

    def run(econ):
        own = learner_from(settings[econ], learner) if settings and econ in settings else learner
        place = f"{results}_fits/horizon={horizon}/{econ}"
        rows, _ = fitted_backtest(
            table.where(F.col("econ") == econ), features, start, end, span, own, ["econ"], label, month, step_months, place, refit_every, 1
        )
        return stored(rows.withColumns({"horizon": F.lit(horizon), "operation_date": F.lit(stamp)}), "economy")

    with ThreadPoolExecutor(max_workers=workers) as pool:
        for done in as_completed([pool.submit(inheritable_thread_target(spark)(lambda e=e: run(e))) for e in todo]):
            insert_ignore(done.result(), results, ["econ", "horizon", "date"], [F.col("operation_date").asc()], ["econ", "horizon"])
    return spark.read.parquet(results)
