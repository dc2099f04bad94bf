"""Classification and regression measures as group-bys over (keys, label, prediction)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.constants import DEFAULT
from firmlens.operators.scores import counts_and_cuts, ranking_measures, ranking_over_windows, roc_auc

PAIRS = [(0, 1), (0, 2)]


def confusion(df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat") -> DataFrame:
    """Row counts per (label, predicted label); the base of the measures below."""
    return df.groupBy(*keys, F.col(label).alias("y"), F.col(predicted).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def per_class(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall and F1 per class of labels and predictions together; 0 where a ratio has no rows.

    ``counts`` is a confusion table; each cell adds to its label's and its prediction's class.
    """
    sides = counts.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("y").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("called")),
                F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("called")),
            )
        ).alias("s"),
        F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0).alias("hit"),
    )
    sums = sides.groupBy(*keys, F.col("s.cls").alias("cls")).agg(
        F.sum("s.actual").alias("actual"),
        F.sum("s.called").alias("called"),
        # A hit cell is met twice, once from each side.
        (F.sum("hit") / 2).alias("hit"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return sums.select(
        *keys, "cls",
        share(F.col("hit"), F.col("called")).alias("prec"),
        share(F.col("hit"), F.col("actual")).alias("rec"),
        share(2 * F.col("hit"), F.col("actual") + F.col("called")).alias("f1"),
    )


def macro_measures(df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat") -> DataFrame:
    """Unweighted class means: (keys, precision_macro, recall_macro, f1_macro)."""
    return per_class(confusion(df, keys, label, predicted), keys).groupBy(*keys).agg(
        F.avg("prec").alias("precision_macro"), F.avg("rec").alias("recall_macro"), F.avg("f1").alias("f1_macro")
    )


def one_vs_one(
    df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat", probs: str = "p",
    pairs: list[tuple[int, int]] = PAIRS, cuts: list[float] | None = None,
) -> DataFrame:
    """Per pair (a, b), over rows labelled a or b, with b as the positive class: f1, precision, recall, auc, ar."""
    wanted = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    rows = df.select(*keys, label, predicted, probs, F.explode(wanted).alias("pair"))
    rows = rows.where((F.col(label) == F.col("pair.a")) | (F.col(label) == F.col("pair.b"))).select(
        *keys,
        F.format_string("class%dv%d", "pair.a", "pair.b").alias("pair"),
        (F.col(label) == F.col("pair.b")).cast("int").alias("pos"),
        (F.col(predicted) == F.col("pair.b")).cast("int").alias("called"),
        F.element_at(probs, F.col("pair.b") + 1).alias("score"),
    )
    by = [*keys, "pair"]
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    hit, called, actual = F.sum(F.col("pos") * F.col("called")), F.sum("called"), F.sum("pos")
    calls = rows.groupBy(*by).agg(
        share(2 * hit, called + actual).alias("f1"), share(hit, called).alias("prec"), share(hit, actual).alias("rec")
    )
    ranks = roc_auc(rows, by, "pos", "score", cuts).select(*by, "auc")
    return calls.join(ranks, by).withColumn("ar", 2 * F.col("auc") - 1)


def auc_one_vs_rest(df: DataFrame, keys: list[str], label: str = "y", probs: str = "p", cuts: list[float] | None = None) -> DataFrame:
    """Mean over classes of the AUC of each class against all others."""
    rows = df.select(*keys, label, F.posexplode(probs).alias("cls", "score"))
    rows = rows.select(*keys, "cls", "score", (F.col(label) == F.col("cls")).cast("int").alias("pos"))
    per_class_auc = roc_auc(rows, [*keys, "cls"], "pos", "score", cuts)
    return per_class_auc.groupBy(*keys).agg(F.avg("auc").alias("auc_ovr_macro"))


def accuracy_ratio(df: DataFrame, keys: list[str], label: str = "y", score: str = "p1", cuts: list[float] | None = None) -> DataFrame:
    """2 * AUC - 1 of default against everything else."""
    rows = df.select(*keys, (F.col(label) == DEFAULT).cast("int").alias("pos"), F.col(score).alias("score"))
    return roc_auc(rows, keys, "pos", "score", cuts).select(*keys, (2 * F.col("auc") - 1).alias("ar"))


def accuracy_ratio_insample(df: DataFrame, keys: list[str], label: str = "y", score: str = "p1", cuts: list[float] | None = None) -> DataFrame:
    """As ``accuracy_ratio`` on rows without exits and with a positive score."""
    return accuracy_ratio(df.where((F.col(label) <= DEFAULT) & (F.col(score) > 0)), keys, label, score, cuts)


def log_loss(df: DataFrame, keys: list[str], label: str = "y", probs: str = "p", eps: float = 2.220446049250313e-16) -> DataFrame:
    """Mean of -ln p[label], clipped away from 0 and 1."""
    hit = F.least(F.greatest(F.element_at(probs, F.col(label).cast("int") + 1), F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*keys).agg(F.avg(-F.log(hit)).alias("log_loss"))


def regression_errors(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """(keys, mse, rmse, r2) in one pass; r2 = 1 - SSE / SST with SST from the merged variance, not raw squares."""
    mse = F.avg(F.pow(F.col(actual) - F.col(predicted), 2))
    spread = F.var_pop(F.col(actual))
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(*keys).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.when(spread > 0, 1 - mse / spread).alias("r2")
    )


def monthly_series(df: DataFrame, keys: list[str], label: str, score: str, month: str = "ym", cuts: list[float] | None = None) -> DataFrame:
    """AUC and PR-AUC of a stored score per month."""
    return ranking_measures(df, [*keys, month], label, score, cuts)


def yearly_series(df: DataFrame, keys: list[str], label: str, score: str, month: str = "ym", cuts: list[float] | None = None) -> DataFrame:
    """AUC and PR-AUC of a stored score per calendar year."""
    return ranking_measures(df.withColumn("year", F.year(month)), [*keys, "year"], label, score, cuts)


def rolling_series(
    df: DataFrame, keys: list[str], label: str, score: str, start, end, span: int = 12, month: str = "ym",
    cuts: list[float] | None = None,
) -> DataFrame:
    """AUC and PR-AUC over windows of ``span`` months starting every month; rows are counted per month first."""
    monthly, cuts = counts_and_cuts(df, [*keys, month], label, score, cuts)
    return ranking_over_windows(monthly, keys, cuts, span, start, end, month)


def compare_to_reference(df: DataFrame, model: str, current: str, reference: str | None, label: str = "y", score: str = "p1",
                         tolerance: float = 0.1, keys: list[str] = (), cuts: list[float] | None = None) -> DataFrame:
    """Current against reference model: both AUCs and ARs, their difference and a pass flag.

    ``df`` holds the rows of both, told apart by column ``model``. With a reference the difference
    (reference - current) must lie within ``tolerance`` of the reference's own AUC level, and is NULL, as is
    ``passed``, where the reference (or the current model) has no rows of one class; only without a reference asked
    for does a model always pass.
    """
    auc = roc_auc(df.select(*keys, model, (F.col(label) == DEFAULT).cast("int").alias("pos"), F.col(score).alias("score")),
                  [*keys, model], "pos", "score", cuts)
    pick = lambda name: F.max(F.when(F.col(model) == name, F.col("auc")))
    both = auc.groupBy(*keys).agg(
        pick(current).alias("auc_current"),
        (pick(reference) if reference is not None else F.lit(None).cast("double")).alias("auc_reference"),
    )
    gap = F.col("auc_reference") - F.col("auc_current")
    return both.withColumns({
        "ar_current": 2 * F.col("auc_current") - 1,
        "ar_reference": 2 * F.col("auc_reference") - 1,
        "auc_difference": gap,
        "passed": F.lit(True) if reference is None else F.abs(gap) <= tolerance * F.abs(F.col("auc_reference")),
    })


def quality_table(df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat", probs: str = "p",
                  cuts: list[float] | None = None) -> DataFrame:
    """Accuracy, macro precision / recall / F1, one-versus-rest AUC and log loss per group."""
    macro = macro_measures(df, keys, label, predicted)
    hit = F.least(F.greatest(F.element_at(probs, F.col(label).cast("int") + 1), F.lit(2.220446049250313e-16)), F.lit(1 - 2.220446049250313e-16))
    simple = df.groupBy(*keys).agg(
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"), F.avg(-F.log(hit)).alias("log_loss")
    )
    return simple.join(macro, keys).join(auc_one_vs_rest(df, keys, label, probs, cuts), keys)


def long_form(df: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Wide measures as rows (keys, metric, value) under their logged names."""
    renamed = df.select(*keys, *[F.col(c).cast("double").alias(n) for c, n in names.items()])
    return renamed.unpivot(keys, list(names.values()), "metric", "value")


# Measures that can be asked for by name: (df, keys, label, predicted, probs) -> DataFrame.
REGISTRY: dict[str, Callable[..., DataFrame]] = {
    "accuracy": lambda df, keys, label, predicted, probs: accuracy(df, keys, label, predicted),
    "macro": lambda df, keys, label, predicted, probs: macro_measures(df, keys, label, predicted),
    "auc_ovr_macro": lambda df, keys, label, predicted, probs: auc_one_vs_rest(df, keys, label, probs),
    "one_vs_one": lambda df, keys, label, predicted, probs: one_vs_one(df, keys, label, predicted, probs),
    "log_loss": lambda df, keys, label, predicted, probs: log_loss(df, keys, label, probs),
}


def measure(name: str, df: DataFrame, keys: list[str], label: str = "y", predicted: str = "yhat", probs: str = "p") -> DataFrame:
    """A measure by its registered name."""
    return REGISTRY[name](df, keys, label, predicted, probs)
