"""Joins, splits, ranking measures, comparisons and attribution tables (J, D, M, L10, L12, L14-L20, X2)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.catalog.inputs import STAR_SQL, metadata_star
from firmlens.catalog.panels import BACKTEST_SQL, backtest_rows, compared_series
from firmlens.catalog.registry import query
from firmlens.functions.columns import argmax_class, as_default_flag, date_from_ints
from firmlens.functions.constants import DROP_KINDS
from firmlens.operators import attribution, joins, labels, metrics, prep, scores, splits
from firmlens.plans import backtest
from firmlens.plans.registry import latest_versions
from firmlens.session import stored
from firmlens.sources import roles
from firmlens.streaming.daily import missing_inputs

P = f"WITH {roles.PANEL_SQL} "
PRED = f"WITH {roles.PREDICTIONS_SQL} "
B = f"WITH {BACKTEST_SQL} "
FIRST, LAST = date(1996, 1, 1), date(2001, 8, 1)
FIRST_TEXT, LAST_TEXT = "DATE '1996-01-01'", "DATE '2001-08-01'"


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return roles.stat_predictions(spark, folder), roles.model_predictions(spark, folder), roles.ground_truth(spark, folder)


# Joins -------------------------------------------------------------------------------------------


@query("join_result_table", "comp_id:i yyyy_mm_dd stats_pd_1:r stats_poe_1:r ml_pd_1:r ml_poe_1:r task_date:d event_type:f", PRED + """
SELECT s.comp_id, strftime(s.yyyymmdd, '%Y-%m-%d') AS yyyy_mm_dd, s.pd_1 AS stats_pd_1, s.poe_1 AS stats_poe_1,
  m.pd_1 AS ml_pd_1, m.poe_1 AS ml_poe_1, s.task_date, t.event_type
FROM stats s LEFT JOIN model m ON s.comp_id = m.comp_id AND s.yyyymmdd = m.yyyymmdd AND s.task_date = m.task_date
LEFT JOIN truth t ON s.comp_id = t.comp_id AND s.yyyymmdd = t.yyyymmdd AND s.task_date = t.task_date""")
def join_result_table(spark: SparkSession, folder: str) -> DataFrame:
    stats, model, truth = _tables(spark, folder)
    short_years = stats.withColumn("yy", F.when(F.col("comp_id") % 2 == 0, F.col("yy") % 100).otherwise(F.col("yy")))
    return joins.result_table(short_years, model, truth)


@query("join_merge_predictions", "comp_id:i yyyymmdd:d task_date:d stats_pd_1:r ml_pd_1:r event_type:f forecast_date", PRED + """,
merged AS (SELECT coalesce(s.comp_id, m.comp_id) AS comp_id, coalesce(s.yyyymmdd, m.yyyymmdd) AS yyyymmdd,
    coalesce(s.task_date, m.task_date) AS task_date, s.pd_1 AS stats_pd_1, m.pd_1 AS ml_pd_1
  FROM stats s FULL JOIN model m ON s.comp_id = m.comp_id AND s.yyyymmdd = m.yyyymmdd AND s.task_date = m.task_date)
SELECT g.*, t.event_type, CASE WHEN day(g.yyyymmdd + INTERVAL 1 MONTH) = day(g.yyyymmdd)
  THEN strftime(g.yyyymmdd + INTERVAL 1 MONTH, '%Y-%m-%d') ELSE 'N/A' END AS forecast_date
FROM merged g LEFT JOIN truth t ON g.comp_id = t.comp_id AND g.yyyymmdd = t.yyyymmdd AND g.task_date = t.task_date""")
def join_merge_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return joins.merged_predictions(*_tables(spark, folder)).orderBy("comp_id", "yyyymmdd")


@query("join_country_metrics", "econ_name metrics_name value:r", f"WITH {STAR_SQL} " + """
SELECT econ_name, metrics_name, value FROM metrics JOIN metrics_type USING (metrics_type_id) JOIN model USING (model_id) JOIN econ USING (econ_id)""")
def join_country_metrics(spark: SparkSession, folder: str) -> DataFrame:
    star = metadata_star(spark, folder)
    return joins.country_metrics(star["econ"], star["model"], star["metrics"], star["metrics_type"])


@query("join_valid_econs", "econ_id:i econ_name", B + """
SELECT n_nationkey AS econ_id, n_name AS econ_name FROM nation WHERE n_nationkey IN (
  SELECT econ FROM backtest WHERE horizon = 12 AND auc_score > 0.9
  UNION SELECT econ FROM backtest WHERE horizon = 1 AND test_positives > test_size * 0.9)""")
def join_valid_econs(spark: SparkSession, folder: str) -> DataFrame:
    rows = backtest_rows(spark, folder)
    scored = rows.where((F.col("horizon") == 12) & (F.col("auc_score") > 0.9))
    stats = rows.where((F.col("horizon") == 1) & (F.col("test_positives") > F.col("test_size") * 0.9))
    return joins.economies_with_results(metadata_star(spark, folder)["econ"], scored, stats)


@query("join_company_semi", "c_custkey:i c_name", PRED + "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT comp_id FROM stats)")
def join_company_semi(spark: SparkSession, folder: str) -> DataFrame:
    info = roles.table(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.companies_with_predictions(info, roles.stat_predictions(spark, folder), "c_custkey")


@query("join_model_comparison", "pair:i horizon:i date:d auc_score_model1:r auc_score_model2:r pr_auc_model1:r pr_auc_model2:r", B + """
SELECT a.econ AS pair, a.horizon, a.date, a.auc_score AS auc_score_model1, b.auc_score AS auc_score_model2,
  a.pr_auc AS pr_auc_model1, b.pr_auc AS pr_auc_model2
FROM backtest a JOIN backtest b ON a.econ % 2 = 0 AND a.econ + 1 = b.econ AND a.date = b.date AND a.horizon = b.horizon
WHERE b.auc_score IS NOT NULL""")
def join_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return compared_series(spark, folder)


_YEARLY_SQL = P + """,
yearly AS (SELECT firm, year, CASE WHEN sum(n_orders) > 1 THEN concat('g', CAST(max(month) AS VARCHAR)) END AS grade,
    max(cents) / 100 AS size FROM panel GROUP BY firm, year),
spine AS (SELECT firm, CAST(unnest(generate_series((SELECT min(year) FROM yearly), 2030)) AS INT) AS year FROM (SELECT DISTINCT firm FROM yearly)),
joined AS (SELECT s.firm, s.year, y.grade AS g, y.size FROM spine s LEFT JOIN yearly y ON s.firm = y.firm AND s.year = y.year)
SELECT firm, year, size, coalesce(
  last_value(g IGNORE NULLS) OVER (PARTITION BY firm ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(g IGNORE NULLS) OVER (PARTITION BY firm ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS grade
FROM joined"""


@query("join_calendar_spine", "firm:i year:i grade size:r", _YEARLY_SQL)
def join_calendar_spine(spark: SparkSession, folder: str) -> DataFrame:
    yearly = roles.panel(spark, folder).groupBy("firm", "year").agg(
        F.when(F.sum("n_orders") > 1, F.concat(F.lit("g"), F.max("month").cast("string"))).alias("grade"),
        (F.max("cents") / 100).alias("size"),
    )
    return joins.calendar_spine(yearly, "firm", "year", ["grade"], ["size"])


@query("join_window_panel", "window:d n_test:i cents:i", P + f"""
SELECT w AS "window", count(*) AS n_test, sum(cents) AS cents FROM panel
JOIN (SELECT CAST(unnest(generate_series({FIRST_TEXT}, {LAST_TEXT}, INTERVAL 1 MONTH)) AS DATE) AS w)
  ON ym >= w AND ym < w + INTERVAL 12 MONTH GROUP BY w""")
def join_window_panel(spark: SparkSession, folder: str) -> DataFrame:
    calendar = splits.month_calendar(spark, FIRST, LAST)
    rows = roles.panel(spark, folder).select("ym", "cents")
    monthly = rows.groupBy("ym").agg(F.count(F.lit(1)).alias("n_test"), F.sum("cents").alias("cents"))
    joined = splits.window_roles(monthly, calendar, 12)
    return joined.groupBy("window").agg(F.sum("n_test").alias("n_test"), F.sum("cents").alias("cents"))


@query("join_month_panel", "window:d firm:i cents:i", P + """
SELECT ym AS "window", firm, cents FROM panel""")
def join_month_panel(spark: SparkSession, folder: str) -> DataFrame:
    panel = roles.panel(spark, folder)
    first, last = panel.agg(F.min("ym"), F.max("ym")).first()  # two months bound the calendar
    return panel.limit(0).select(F.col("ym").alias("window"), "firm", "cents") if first is None else splits.window_roles(panel, splits.month_calendar(spark, first, last), 1)


# Splits ------------------------------------------------------------------------------------------


@query("split_holdout_years", "firm:i ym:d role", P + """
SELECT firm, ym, CASE WHEN year IN (SELECT DISTINCT year FROM panel ORDER BY year DESC LIMIT 3) THEN 'test' ELSE 'train' END AS role FROM panel""")
def split_holdout_years(spark: SparkSession, folder: str) -> DataFrame:
    return splits.holdout_years(roles.panel(spark, folder))


_BLOCKS_SQL = P + """,
numbered AS (SELECT firm, ym, row_number() OVER (ORDER BY ym, firm) - 1 AS i, count(*) OVER () AS n FROM panel),
blocks AS (SELECT firm, ym, i, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS block FROM numbered)"""


@query("split_expanding_kfold", "firm:i ym:d block:i", _BLOCKS_SQL + " SELECT firm, ym, block FROM blocks")
def split_expanding_kfold(spark: SparkSession, folder: str) -> DataFrame:
    return splits.expanding_blocks(stored(roles.panel(spark, folder).select("firm", "ym")), 5)


@query("agg_fold_ranges", "fold:i role first_day:d last_day:d first_row:i last_row:i n_rows:i", _BLOCKS_SQL + """
SELECT fold, CASE WHEN block = fold THEN 'val' ELSE 'train' END AS role, min(ym) AS first_day, max(ym) AS last_day,
  min(i) AS first_row, max(i) AS last_row, count(*) AS n_rows
FROM blocks JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS fold) ON block <= fold GROUP BY ALL""")
def agg_fold_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return splits.fold_ranges(splits.expanding_blocks(stored(roles.panel(spark, folder).select("firm", "ym")), 5))


@query("split_year", "role n_rows:i n_default:i", P + """
SELECT CASE WHEN year = 2000 THEN 'test' ELSE 'train' END AS role, count(*) AS n_rows, sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) AS n_default
FROM panel WHERE year <= 2000 GROUP BY 1""")
def split_year(spark: SparkSession, folder: str) -> DataFrame:
    tagged = splits.year_split(roles.panel(spark, folder), 2000)
    return tagged.groupBy("role").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("Y") == 1).alias("n_default"))


@query("split_month", "role n_rows:i n_default:i", P + """
SELECT CASE WHEN ym = DATE '2000-06-01' THEN 'test' ELSE 'train' END AS role, count(*) AS n_rows, sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) AS n_default
FROM panel WHERE ym <= DATE '2000-06-01' GROUP BY 1""")
def split_month(spark: SparkSession, folder: str) -> DataFrame:
    tagged = splits.month_split(roles.panel(spark, folder), date(2000, 6, 1))
    return tagged.groupBy("role").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("Y") == 1).alias("n_default"))


def _windows_sql(span: int) -> str:
    part = lambda side, on: ", ".join(
        [f"(SELECT count(*) FROM panel p WHERE {on}) AS {side}_n_rows"]
        + [f"(SELECT count(*) FROM panel p WHERE {on} AND Y = {k}) AS {side}_n{k}" for k in (0, 1, 2)]
    )
    test_on = f"p.ym >= w AND p.ym < w + INTERVAL {span} MONTH"
    return P + f"""
SELECT w AS "window", {part('train', 'p.ym < w')}, {part('test', test_on)}
FROM (SELECT CAST(unnest(generate_series({FIRST_TEXT}, {LAST_TEXT}, INTERVAL 1 MONTH)) AS DATE) AS w)"""


_WINDOW_COLUMNS = "window:d " + " ".join(f"{s}_{c}:i" for s in ("train", "test") for c in ("n_rows", "n0", "n1", "n2"))


@query("split_windows_monthly", _WINDOW_COLUMNS, _windows_sql(1))
def split_windows_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return splits.window_class_counts(roles.panel(spark, folder), [], 1, FIRST, LAST)


@query("split_windows_12m", _WINDOW_COLUMNS, _windows_sql(12))
def split_windows_12m(spark: SparkSession, folder: str) -> DataFrame:
    return splits.window_class_counts(roles.panel(spark, folder), [], 12, FIRST, LAST)


@query("split_calendar", "window:d n_firms:i", P + f"""
SELECT w AS "window", count(firm) AS n_firms FROM (SELECT CAST(unnest(generate_series({FIRST_TEXT}, {LAST_TEXT}, INTERVAL 1 MONTH)) AS DATE) AS w)
LEFT JOIN panel ON ym = w GROUP BY w""")
def split_calendar(spark: SparkSession, folder: str) -> DataFrame:
    firms = roles.panel(spark, folder).groupBy(F.col("ym").alias("window")).agg(F.count("firm").alias("n_firms"))
    return splits.month_calendar(spark, FIRST, LAST).join(firms, "window", "left").fillna(0, subset=["n_firms"])


_GUARDS_SQL = """
, lim AS (SELECT CAST(unnest(generate_series(DATE '1994-11-01', DATE '2001-10-01', INTERVAL 1 MONTH)) AS DATE) AS w),
grid AS (SELECT econ, w FROM (SELECT DISTINCT econ FROM panel), lim),
tests AS (SELECT econ, w, count(*) AS n, count(DISTINCT Y) AS k, sum(CASE WHEN Y < 2 THEN 1 ELSE 0 END) AS m
  FROM panel JOIN lim ON ym = w GROUP BY econ, w),
trains AS (SELECT econ, w, count(*) AS n, count(DISTINCT Y) AS k FROM panel JOIN lim ON ym < w GROUP BY econ, w)
SELECT g.econ, g.w AS "window", CASE WHEN t.n IS NULL OR r.n IS NULL THEN 'no_rows' WHEN r.k < 2 THEN 'one_train_class'
  WHEN t.k < 2 THEN 'one_test_class' WHEN t.m = 0 THEN 'exits_only' ELSE 'scored' END AS status
FROM grid g LEFT JOIN tests t ON g.econ = t.econ AND g.w = t.w LEFT JOIN trains r ON g.econ = r.econ AND g.w = r.w"""


@query("split_window_guards", "econ:i window:d status", P + _GUARDS_SQL)
def split_window_guards(spark: SparkSession, folder: str) -> DataFrame:
    counts = splits.window_class_counts(roles.panel(spark, folder), ["econ"], 1, date(1994, 11, 1), date(2001, 10, 1))
    return splits.with_window_status(counts)


@query("agg_window_sizes", "econ:i window:d train_size:i test_size:i test_positives:i test_samples:i", P + f"""
, lim AS (SELECT CAST(unnest(generate_series({FIRST_TEXT}, {LAST_TEXT}, INTERVAL 1 MONTH)) AS DATE) AS w)
SELECT econ, w AS "window", sum(CASE WHEN ym < w THEN 1 ELSE 0 END) AS train_size,
  sum(CASE WHEN ym >= w AND ym < w + INTERVAL 12 MONTH THEN 1 ELSE 0 END) AS test_size,
  sum(CASE WHEN ym >= w AND ym < w + INTERVAL 12 MONTH AND Y = 1 THEN 1 ELSE 0 END) AS test_positives,
  sum(CASE WHEN ym >= w AND ym < w + INTERVAL 12 MONTH AND Y < 2 THEN 1 ELSE 0 END) AS test_samples
FROM panel, lim GROUP BY econ, w""")
def agg_window_sizes(spark: SparkSession, folder: str) -> DataFrame:
    counts = splits.window_class_counts(roles.panel(spark, folder), ["econ"], 12, FIRST, LAST)
    return counts.select(
        "econ", "window", F.col("train_n_rows").alias("train_size"), F.col("test_n_rows").alias("test_size"),
        F.col("test_n1").alias("test_positives"), (F.col("test_n0") + F.col("test_n1")).alias("test_samples"),
    )


# Ranking and classification measures ---------------------------------------------------------------


def scored_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Panel rows with label y, stored probabilities p, p0..p2 and predicted class yhat."""
    scored = roles.three_class_scores(roles.panel(spark, folder))
    return scored.withColumns({"y": F.col("Y"), "yhat": argmax_class("p"), "flag": as_default_flag("Y")})


S = f"""WITH {roles.SCORED_SQL},
rated AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS yhat,
  CASE WHEN Y = 1 THEN 1 ELSE 0 END AS flag FROM scored) """


def auc_ctes(source: str, keys: str, label: str, score: str, where: str = "true", name: str = "aucs") -> str:
    """Rank-sum form of the AUC per group, as common table expressions."""
    return f"""ranks_{name} AS (SELECT {keys}, {label} AS l, rank() OVER (PARTITION BY {keys} ORDER BY {score})
    + (count(*) OVER (PARTITION BY {keys}, {score}) - 1) / 2 AS r FROM {source} WHERE {where}),
{name} AS (SELECT {keys}, CAST(sum(l) AS BIGINT) AS n_pos, CAST(count(*) - sum(l) AS BIGINT) AS n_neg,
    CASE WHEN sum(l) > 0 AND sum(l) < count(*) THEN (sum(CASE WHEN l = 1 THEN r END) - sum(l) * (sum(l) + 1) / 2)
      / (sum(l) * (count(*) - sum(l))) END AS auc FROM ranks_{name} GROUP BY {keys})"""


def pr_ctes(source: str, keys: str, label: str, score: str, where: str = "true", name: str = "prs") -> str:
    """Trapezoid PR-AUC per group with an explicit anchor point and lag."""
    w = f"PARTITION BY {keys} ORDER BY s DESC"
    return f"""cells_{name} AS (SELECT {keys}, {score} AS s, sum({label}) AS tp, count(*) AS n FROM {source} WHERE {where} GROUP BY {keys}, {score}),
points_{name} AS (SELECT {keys}, s, tp, sum(tp) OVER ({w}) / sum(n) OVER ({w}) AS prec, sum(tp) OVER ({w}) AS ctp,
    sum(tp) OVER (PARTITION BY {keys}) AS pos FROM cells_{name}),
steps_{name} AS (SELECT *, coalesce(lag(prec) OVER ({w}), 1.0) AS prec0, coalesce(lag(ctp) OVER ({w}), 0) AS ctp0 FROM points_{name}),
{name} AS (SELECT {keys}, CASE WHEN max(pos) = 0 THEN 0.5 ELSE sum((ctp - ctp0) * (prec + prec0) / 2) / max(pos) END AS pr_auc
  FROM steps_{name} GROUP BY {keys})"""


@query("met_confusion", "econ:i y:i yhat:i n:i", S + "SELECT econ, Y AS y, yhat, count(*) AS n FROM rated GROUP BY econ, Y, yhat")
def met_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(scored_panel(spark, folder), ["econ"])


@query("met_accuracy", "econ:i accuracy:r", S + "SELECT econ, avg(CASE WHEN Y = yhat THEN 1.0 ELSE 0.0 END) AS accuracy FROM rated GROUP BY econ")
def met_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.accuracy(scored_panel(spark, folder), ["econ"])


_CLASSES_SQL = S + """, per AS (
  SELECT econ, cls, sum(CASE WHEN yhat = cls AND Y = cls THEN 1 ELSE 0 END) AS hit, sum(CASE WHEN yhat = cls THEN 1 ELSE 0 END) AS called,
    sum(CASE WHEN Y = cls THEN 1 ELSE 0 END) AS actual FROM rated, (SELECT unnest([0, 1, 2]) AS cls) GROUP BY econ, cls),
macro AS (SELECT econ, avg(CASE WHEN called > 0 THEN hit / called ELSE 0.0 END) AS precision_macro,
  avg(CASE WHEN actual > 0 THEN hit / actual ELSE 0.0 END) AS recall_macro,
  avg(CASE WHEN actual + called > 0 THEN 2 * hit / (actual + called) ELSE 0.0 END) AS f1_macro
  FROM per WHERE called + actual > 0 GROUP BY econ)"""


@query("met_precision_macro", "econ:i precision_macro:r", _CLASSES_SQL + " SELECT econ, precision_macro FROM macro")
def met_precision_macro(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.macro_measures(scored_panel(spark, folder), ["econ"])


@query("met_recall_macro", "econ:i recall_macro:r", _CLASSES_SQL + " SELECT econ, recall_macro FROM macro")
def met_recall_macro(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.macro_measures(scored_panel(spark, folder), ["econ"])


@query("met_f1_macro", "econ:i f1_macro:r", _CLASSES_SQL + " SELECT econ, f1_macro FROM macro")
def met_f1_macro(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.macro_measures(scored_panel(spark, folder), ["econ"])


_OVO_SQL = S + """, pairs AS (
  SELECT econ, 'class0v1' AS pair, CASE WHEN Y = 1 THEN 1 ELSE 0 END AS pos, CASE WHEN yhat = 1 THEN 1 ELSE 0 END AS called, p1 AS score
    FROM rated WHERE Y IN (0, 1)
  UNION ALL SELECT econ, 'class0v2', CASE WHEN Y = 2 THEN 1 ELSE 0 END, CASE WHEN yhat = 2 THEN 1 ELSE 0 END, p2 FROM rated WHERE Y IN (0, 2)), """ + auc_ctes(
    "pairs", "econ, pair", "pos", "score") + """,
calls AS (SELECT econ, pair, sum(pos * called) AS hit, sum(called) AS called, sum(pos) AS actual FROM pairs GROUP BY econ, pair)
SELECT econ, pair, CASE WHEN called + actual > 0 THEN 2 * hit / (called + actual) ELSE 0.0 END AS f1,
  CASE WHEN called > 0 THEN hit / called ELSE 0.0 END AS prec, CASE WHEN actual > 0 THEN hit / actual ELSE 0.0 END AS rec,
  auc, 2 * auc - 1 AS ar FROM calls JOIN aucs USING (econ, pair)"""


@query("met_ovo", "econ:i pair f1:r prec:r rec:r auc:r ar:r", _OVO_SQL)
def met_ovo(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.one_vs_one(scored_panel(spark, folder), ["econ"])


@query("met_roc_auc", "econ:i n_pos:i n_neg:i auc:r", S + ", " + auc_ctes("rated", "econ", "flag", "p1") + " SELECT * FROM aucs")
def met_roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return scores.roc_auc(scored_panel(spark, folder), ["econ"], "flag", "p1")


_OVR_SQL = S + """, longer AS (
  SELECT econ, 0 AS cls, CASE WHEN Y = 0 THEN 1 ELSE 0 END AS pos, p0 AS score FROM rated
  UNION ALL SELECT econ, 1, CASE WHEN Y = 1 THEN 1 ELSE 0 END, p1 FROM rated
  UNION ALL SELECT econ, 2, CASE WHEN Y = 2 THEN 1 ELSE 0 END, p2 FROM rated), """ + auc_ctes("longer", "econ, cls", "pos", "score")


@query("met_roc_auc_ovr_macro", "econ:i auc_ovr_macro:r", _OVR_SQL + " SELECT econ, avg(auc) AS auc_ovr_macro FROM aucs GROUP BY econ")
def met_roc_auc_ovr_macro(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.auc_one_vs_rest(scored_panel(spark, folder), ["econ"])


@query("met_accuracy_ratio", "econ:i ar:r", S + ", " + auc_ctes("rated", "econ", "flag", "p1") + " SELECT econ, 2 * auc - 1 AS ar FROM aucs")
def met_accuracy_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.accuracy_ratio(scored_panel(spark, folder), ["econ"])


@query("met_ar_insample", "econ:i ar:r", S + ", " + auc_ctes("rated", "econ", "flag", "p1", "Y <= 1 AND p1 > 0") + " SELECT econ, 2 * auc - 1 AS ar FROM aucs")
def met_ar_insample(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.accuracy_ratio_insample(scored_panel(spark, folder), ["econ"])


_TOXIC_SQL = """WITH texts AS (SELECT lang, toxic, n_chars % 997 / 997 AS score FROM labels JOIN documents USING (doc_id)),
cells AS (SELECT lang, score, sum(toxic) AS tp, count(*) AS n FROM texts GROUP BY lang, score),
points AS (SELECT lang, score AS threshold, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn, sum(tp) OVER (PARTITION BY lang) AS pos,
  sum(n - tp) OVER (PARTITION BY lang) AS neg FROM cells WINDOW w AS (PARTITION BY lang ORDER BY score DESC))"""


def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Binary labels with a score from the length of the labelled text."""
    documents = roles.table(spark, folder, "documents").select("doc_id", "lang", (F.col("n_chars") % 997 / 997).alias("score"))
    return roles.table(spark, folder, "labels").join(documents, "doc_id")


@query("met_roc_curve", "lang threshold:r fpr:r tpr:r", _TOXIC_SQL + """
SELECT lang, threshold, CASE WHEN neg > 0 THEN (cn - ctp) / neg END AS fpr, CASE WHEN pos > 0 THEN ctp / pos END AS tpr FROM points""")
def met_roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return scores.roc_curve(toxic_scores(spark, folder), ["lang"], "toxic", "score")


@query("met_roc_curve_turns", "lang threshold:r fpr:r tpr:r", _TOXIC_SQL + """,
turns AS (SELECT lang, score, tp, n, row_number() OVER w = 1 AS is_first, lead(tp) OVER w AS next_tp, lead(n) OVER w AS next_n
  FROM cells WINDOW w AS (PARTITION BY lang ORDER BY score DESC))
SELECT lang, threshold, CASE WHEN neg > 0 THEN (cn - ctp) / neg END AS fpr, CASE WHEN pos > 0 THEN ctp / pos END AS tpr
FROM points JOIN turns ON points.lang = turns.lang AND points.threshold = turns.score
WHERE is_first OR next_n IS NULL OR tp <> next_tp OR n <> next_n""".replace("SELECT lang, threshold, CASE", "SELECT points.lang, threshold, CASE"))
def met_roc_curve_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The ROC curve without the points that lie on a straight line."""
    return scores.roc_curve(toxic_scores(spark, folder), ["lang"], "toxic", "score", drop_collinear=True)


@query("met_pr_curve", "lang threshold:r prec:r rec:r", _TOXIC_SQL + """
SELECT lang, threshold, ctp / cn AS prec, CASE WHEN pos > 0 THEN ctp / pos ELSE 1.0 END AS rec FROM points""")
def met_pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return scores.pr_curve(toxic_scores(spark, folder), ["lang"], "toxic", "score")


@query("met_pr_auc", "econ:i pr_auc:r", S + ", " + pr_ctes("rated", "econ", "flag", "p1") + " SELECT econ, pr_auc FROM prs")
def met_pr_auc(spark: SparkSession, folder: str) -> DataFrame:
    return scores.ranking_measures(scored_panel(spark, folder), ["econ"], "flag", "p1")


@query("met_log_loss", "econ:i log_loss:r", S + """
SELECT econ, avg(-ln(CASE Y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)) AS log_loss FROM rated GROUP BY econ""")
def met_log_loss(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.log_loss(scored_panel(spark, folder), ["econ"])


_REG = """WITH pairs AS (SELECT n_regionkey AS region, c_acctbal / 100 AS actual, (CAST(round(c_acctbal * 100) AS BIGINT) % 1999) / 100 AS predicted
  FROM customer JOIN nation ON c_nationkey = n_nationkey) """


def regression_pairs(spark: SparkSession, folder: str) -> DataFrame:
    nation = roles.table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region"))
    customer = roles.table(spark, folder, "customer")
    return customer.join(nation, "c_nationkey").select(
        "region", (F.col("c_acctbal") / 100).alias("actual"), (roles.cents("c_acctbal") % 1999 / 100).alias("predicted")
    )


@query("met_mse", "region:i mse:r", _REG + "SELECT region, avg((actual - predicted) * (actual - predicted)) AS mse FROM pairs GROUP BY region")
def met_mse(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.regression_errors(regression_pairs(spark, folder), ["region"], "actual", "predicted")


@query("met_rmse", "region:i rmse:r", _REG + "SELECT region, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse FROM pairs GROUP BY region")
def met_rmse(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.regression_errors(regression_pairs(spark, folder), ["region"], "actual", "predicted")


@query("met_r2", "region:i r2:r", _REG + """, means AS (SELECT region, avg(actual) AS m FROM pairs GROUP BY region)
SELECT region, 1 - sum((actual - predicted) * (actual - predicted)) / sum((actual - m) * (actual - m)) AS r2 FROM pairs JOIN means USING (region) GROUP BY region""")
def met_r2(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.regression_errors(regression_pairs(spark, folder), ["region"], "actual", "predicted")


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.outcome_predictions(spark, folder)
    known = prep.known_outcomes(df, "is_default_1m")
    return known.withColumn("ym", date_from_ints("yyyymm", "yyyyMM"))


def _series_sql(keys: str, prepare: str, score: str) -> str:
    rows = f"WITH {roles.OUTCOMES_SQL}, rows_ AS (SELECT *, year(ym) AS year FROM outcomes WHERE is_default <> -1), tests AS ({prepare})"
    return rows + ", " + auc_ctes("tests", keys, "is_default", score) + ", " + pr_ctes("tests", keys, "is_default", score) + f"""
SELECT {keys}, auc, pr_auc FROM aucs JOIN prs USING ({keys})"""


_CAL = f"(SELECT CAST(unnest(generate_series({FIRST_TEXT}, {LAST_TEXT}, INTERVAL 1 MONTH)) AS DATE) AS win)"


@query("met_monthly_series", "ym:d auc:r pr_auc:r", _series_sql("ym", "SELECT * FROM rows_", "pd_1m"))
def met_monthly_series(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.monthly_series(outcomes(spark, folder), [], "is_default_1m", "pd_1m")


@query("met_calendar_year_series", "year:i auc:r pr_auc:r", _series_sql("year", "SELECT * FROM rows_", "pd_12m"))
def met_calendar_year_series(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.yearly_series(outcomes(spark, folder), [], "is_default_12m", "pd_12m")


@query("met_12m_series", "win:d auc:r pr_auc:r",
       _series_sql("win", f"SELECT * FROM rows_ JOIN {_CAL} ON ym >= win AND ym < win + INTERVAL 12 MONTH", "pd_12m"))
def met_12m_series(spark: SparkSession, folder: str) -> DataFrame:
    df = outcomes(spark, folder)
    return metrics.rolling_series(df, [], "is_default_12m", "pd_12m", FIRST, LAST).withColumnRenamed("window", "win")


_BY_ECON_SQL = (
    f"WITH {roles.OUTCOMES_SQL}, rows_ AS (SELECT * FROM outcomes WHERE is_default <> -1), "
    f"both_ AS (SELECT 1 AS horizon, econ, ym AS win, is_default, pd_1m AS score FROM rows_ "
    f"UNION ALL SELECT 12, econ, win, is_default, pd_12m FROM rows_ JOIN {_CAL} ON ym >= win AND ym < win + INTERVAL 12 MONTH), "
    + auc_ctes("both_", "horizon, econ, win", "is_default", "score") + ", " + pr_ctes("both_", "horizon, econ, win", "is_default", "score")
    + " SELECT horizon, econ, win, auc, pr_auc FROM aucs JOIN prs USING (horizon, econ, win)"
)


@query("met_series_by_econ", "horizon:i econ:i win:d auc:r pr_auc:r", _BY_ECON_SQL)
def met_series_by_econ(spark: SparkSession, folder: str) -> DataFrame:
    df = stored(outcomes(spark, folder), "outcomes")
    monthly = metrics.monthly_series(df, ["econ"], "is_default_1m", "pd_1m").withColumnRenamed("ym", "win")
    rolling = metrics.rolling_series(df, ["econ"], "is_default_12m", "pd_12m", FIRST, LAST).withColumnRenamed("window", "win")
    return prep.stamped(monthly, horizon=1).unionByName(prep.stamped(rolling, horizon=12))


def two_models(spark: SparkSession, folder: str) -> DataFrame:
    """The stored score under two model names: as it is, and with its classes swapped."""
    rows = scored_panel(spark, folder)
    current = rows.select("econ", "y", "p", "p1", "yhat", F.lit("current").alias("model"))
    swapped = rows.select("econ", "y", F.array("p1", "p0", "p2").alias("p"), F.col("p0").alias("p1"),
                          argmax_class(F.array("p1", "p0", "p2")).alias("yhat"), F.lit("reference").alias("model"))
    return current.unionByName(swapped)


_TWO = S + """, models AS (
  SELECT econ, Y AS y, p0, p1, p2, yhat, 'current' AS model FROM rated
  UNION ALL SELECT econ, Y, p1, p0, p2, CASE WHEN p1 >= p0 AND p1 >= p2 THEN 0 WHEN p0 >= p2 THEN 1 ELSE 2 END, 'reference' FROM rated),
flags AS (SELECT *, CASE WHEN y = 1 THEN 1 ELSE 0 END AS flag FROM models), """


@query("met_ar_vs_reference", "econ:i auc_current:r auc_reference:r ar_current:r ar_reference:r auc_difference:r passed:i",
       _TWO + auc_ctes("flags", "econ, model", "flag", "p1") + """
SELECT a.econ, a.auc AS auc_current, b.auc AS auc_reference, 2 * a.auc - 1 AS ar_current, 2 * b.auc - 1 AS ar_reference,
  b.auc - a.auc AS auc_difference, abs(b.auc - a.auc) <= 0.1 * abs(b.auc) AS passed
FROM aucs a LEFT JOIN aucs b ON a.econ = b.econ AND b.model = 'reference' AND a.econ % 5 <> 0 WHERE a.model = 'current'""")
def met_ar_vs_reference(spark: SparkSession, folder: str) -> DataFrame:
    # Every fifth economy has no reference model.
    rows = two_models(spark, folder).where((F.col("model") == "current") | (F.col("econ") % 5 != 0))
    return metrics.compare_to_reference(rows, "model", "current", "reference", keys=["econ"])


@query("met_roc_vs_reference", "econ:i threshold:r fpr_current:r tpr_current:r fpr_reference:r tpr_reference:r", _TWO + """
compared AS (SELECT * FROM flags WHERE model = 'current' OR econ % 5 <> 0),
cells AS (SELECT econ, p1, sum(CASE WHEN model = 'current' THEN flag ELSE 0 END) AS cp, sum(CASE WHEN model = 'current' THEN 1 - flag ELSE 0 END) AS cn,
  sum(CASE WHEN model = 'reference' THEN flag ELSE 0 END) AS rp, sum(CASE WHEN model = 'reference' THEN 1 - flag ELSE 0 END) AS rn
  FROM compared GROUP BY econ, p1)
SELECT econ, p1 AS threshold, sum(cn) OVER w / nullif(sum(cn) OVER g, 0) AS fpr_current, sum(cp) OVER w / nullif(sum(cp) OVER g, 0) AS tpr_current,
  sum(rn) OVER w / nullif(sum(rn) OVER g, 0) AS fpr_reference, sum(rp) OVER w / nullif(sum(rp) OVER g, 0) AS tpr_reference
FROM cells WINDOW w AS (PARTITION BY econ ORDER BY p1 DESC), g AS (PARTITION BY econ)""")
def met_roc_vs_reference(spark: SparkSession, folder: str) -> DataFrame:
    """Both models' ROC curves on one axis of thresholds. Every fifth economy has no reference model."""
    rows = two_models(spark, folder).where((F.col("model") == "current") | (F.col("econ") % 5 != 0))
    return scores.roc_curves_of_two(rows.withColumn("flag", (F.col("y") == 1).cast("int")), ["econ"], "model", "current", "reference", "flag", "p1")


_QUALITY_SQL = _TWO + """per AS (
  SELECT model, cls, sum(CASE WHEN yhat = cls AND y = cls THEN 1 ELSE 0 END) AS hit, sum(CASE WHEN yhat = cls THEN 1 ELSE 0 END) AS called,
    sum(CASE WHEN y = cls THEN 1 ELSE 0 END) AS actual FROM flags, (SELECT unnest([0, 1, 2]) AS cls) GROUP BY model, cls),
macro AS (SELECT model, avg(CASE WHEN called > 0 THEN hit / called ELSE 0.0 END) AS precision_macro,
  avg(CASE WHEN actual > 0 THEN hit / actual ELSE 0.0 END) AS recall_macro,
  avg(CASE WHEN actual + called > 0 THEN 2 * hit / (actual + called) ELSE 0.0 END) AS f1_macro FROM per WHERE called + actual > 0 GROUP BY model),
longer AS (SELECT model, 0 AS cls, CASE WHEN y = 0 THEN 1 ELSE 0 END AS pos, p0 AS score FROM flags
  UNION ALL SELECT model, 1, CASE WHEN y = 1 THEN 1 ELSE 0 END, p1 FROM flags
  UNION ALL SELECT model, 2, CASE WHEN y = 2 THEN 1 ELSE 0 END, p2 FROM flags), """ + auc_ctes("longer", "model, cls", "pos", "score") + """,
simple AS (SELECT model, avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) AS accuracy,
  avg(-ln(CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)) AS log_loss FROM flags GROUP BY model)
SELECT model, accuracy, log_loss, precision_macro, recall_macro, f1_macro, auc_ovr_macro
FROM simple JOIN macro USING (model) JOIN (SELECT model, avg(auc) AS auc_ovr_macro FROM aucs GROUP BY model) USING (model)"""


@query("met_quality_table", "model accuracy:r log_loss:r precision_macro:r recall_macro:r f1_macro:r auc_ovr_macro:r", _QUALITY_SQL)
def met_quality_table(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.quality_table(stored(two_models(spark, folder), "models"), ["model"])


@query("met_long_form", "run_id metric value:r", _QUALITY_SQL.replace("SELECT model, accuracy, log_loss, precision_macro", ", wide AS (SELECT model, accuracy, log_loss, precision_macro").rstrip() + """)
SELECT model AS run_id, 'outsample_ovr_auc' AS metric, auc_ovr_macro AS value FROM wide
UNION ALL SELECT model, 'outsample_ovr_f1_macro', f1_macro FROM wide
UNION ALL SELECT model, 'outsample_ovr_precision_macro', precision_macro FROM wide
UNION ALL SELECT model, 'outsample_ovr_recall_macro', recall_macro FROM wide
UNION ALL SELECT model, 'outsample_accuracy', accuracy FROM wide""")
def met_long_form(spark: SparkSession, folder: str) -> DataFrame:
    wide = metrics.quality_table(stored(two_models(spark, folder), "models"), ["model"]).withColumnRenamed("model", "run_id")
    names = {"auc_ovr_macro": "outsample_ovr_auc", "f1_macro": "outsample_ovr_f1_macro", "precision_macro": "outsample_ovr_precision_macro",
             "recall_macro": "outsample_ovr_recall_macro", "accuracy": "outsample_accuracy"}
    return metrics.long_form(wide, ["run_id"], names)


# Backtest core, registry, attribution tables, completeness ------------------------------------------

_CORE_SQL = f"""WITH {roles.PANEL_SQL},
led AS (SELECT econ, firm, ym, lead(Y, 3) OVER (PARTITION BY firm ORDER BY ym) AS y3, (max_cents % 1009) / 1009 AS score FROM panel),
known AS (SELECT * FROM led WHERE y3 IS NOT NULL AND round(score * 1009) % 50 <> 7),
tests AS (SELECT econ, win, y3, score FROM known JOIN {_CAL} ON ym >= win AND ym < win + INTERVAL 12 MONTH),
trains AS (SELECT econ, win, count(*) AS train_size, count(DISTINCT y3) AS k FROM known JOIN {_CAL} ON ym < win GROUP BY econ, win),
sizes AS (SELECT econ, win, count(*) AS test_size, count(DISTINCT y3) AS kt, sum(CASE WHEN y3 = 1 THEN 1 ELSE 0 END) AS pos,
  sum(CASE WHEN y3 < 2 THEN 1 ELSE 0 END) AS samples FROM tests GROUP BY econ, win), """ + auc_ctes(
    "tests", "econ, win", "y3", "score", "y3 < 2") + ", " + pr_ctes("tests", "econ, win", "y3", "score", "y3 < 2") + """
SELECT s.econ, s.win AS date, CASE WHEN k >= 2 THEN auc END AS auc_score, CASE WHEN k >= 2 THEN pr_auc ELSE 0.5 END AS pr_auc,
  train_size, test_size, CASE WHEN k >= 2 THEN pos ELSE 0 END AS test_positives, CASE WHEN k >= 2 THEN samples END AS test_samples
FROM sizes s JOIN trains t ON s.econ = t.econ AND s.win = t.win LEFT JOIN aucs a ON s.econ = a.econ AND s.win = a.win
LEFT JOIN prs p ON s.econ = p.econ AND s.win = p.win
WHERE k < 2 OR (kt >= 2 AND samples > 0)"""


@query("bt_relational_core", "econ:i date:d auc_score:r pr_auc:r train_size:i test_size:i test_positives:i test_samples:f", _CORE_SQL)
def bt_relational_core(spark: SparkSession, folder: str) -> DataFrame:
    # Some scores are NaN; such rows take no part.
    rest = F.col("max_cents") % 1009
    df = roles.panel(spark, folder).withColumn("score", F.when(rest % 50 == 7, float("nan")).otherwise(rest / 1009))
    led = labels.lead_label_known(df.select("econ", "firm", "ym", "Y", "score"), 3)
    return backtest.relational_backtest(led, ["econ"], FIRST, LAST, 12)


@query("reg_latest_version", "name version:i path", """
SELECT name, max(version) AS version, arg_max(path, version) AS path FROM (
  SELECT concat('model_', CAST(l_suppkey AS VARCHAR)) AS name, l_orderkey * 10 + l_linenumber AS version,
    concat('models/', CAST(l_suppkey AS VARCHAR), '/', CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)) AS path FROM lineitem) GROUP BY name""")
def reg_latest_version(spark: SparkSession, folder: str) -> DataFrame:
    version = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = roles.table(spark, folder, "lineitem").select(
        F.concat(F.lit("model_"), F.col("l_suppkey")).alias("name"), version.alias("version"),
        F.concat(F.lit("models/"), F.col("l_suppkey"), F.lit("/"), version).alias("path"),
    )
    return latest_versions(rows)


WEIGHTS = {"sizelevel": 0.25, "sizetrend": -0.5, "m2b": 2.0, "sigma": -1.0, "liqfinlevel": 0.125}


def _linear_sql() -> str:
    means = ", ".join(f"avg(coalesce({f}, 0)) AS m_{f}" for f in WEIGHTS)
    rows = " UNION ALL ".join(
        f"SELECT year, '{f}' AS feature, avg(abs({w} * (coalesce({f}, 0) - m_{f}))) AS importance FROM panel JOIN means USING (year) GROUP BY year"
        for f, w in WEIGHTS.items()
    )
    return P + f", means AS (SELECT year, {means} FROM panel GROUP BY year) {rows}"


@query("attr_linear", "year:i feature importance:r", _linear_sql())
def attr_linear(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.linear_attribution(roles.panel(spark, folder), WEIGHTS, ["year"])


_IMP = f"WITH {roles.IMPORTANCE_SQL} "
_RANKED = _IMP + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY importance DESC, feature) AS rank FROM importances) "


@query("attr_mean_over_windows", "feature mean_importance:r", _IMP + """
SELECT feature, avg(importance) AS mean_importance FROM importances GROUP BY feature ORDER BY mean_importance DESC, feature LIMIT 15""")
def attr_mean_over_windows(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.top_mean_features(roles.importances(spark, folder))


@query("attr_feature_stability", "feature appearances:i appearance_rate:r avg_rank:r avg_importance:r importance_std:r", _RANKED + """
SELECT feature, count(*) AS appearances, count(*) / (SELECT count(DISTINCT year) FROM importances) AS appearance_rate, avg(rank) AS avg_rank,
  avg(importance) AS avg_importance, stddev_pop(importance) AS importance_std FROM ranked WHERE rank <= 3 GROUP BY feature""")
def attr_feature_stability(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.feature_stability(roles.importances(spark, folder), 3)


_NAMES = ["cents", "econ", "label", "low", "month", "orders", "top"]


@query("attr_matrix_pivot", "year:i " + " ".join(f"{n}:r" for n in _NAMES), _IMP + "SELECT year, " + ", ".join(
    f"coalesce(max(CASE WHEN feature = '{n}' THEN importance END), 0) AS {n}" for n in _NAMES) + " FROM importances GROUP BY year")
def attr_matrix_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.importance_matrix(roles.importances(spark, folder), _NAMES)


@query("attr_rank_evolution", "year:i feature rank:i", _RANKED + """,
kept AS (SELECT * FROM ranked WHERE NOT (year % 2 = 0 AND feature = 'top')),
again AS (SELECT year, feature, importance, row_number() OVER (PARTITION BY year ORDER BY importance DESC, feature) AS rank FROM kept)
SELECT y.year, f.feature, coalesce(a.rank, y.last_rank) AS rank
FROM (SELECT year, count(*) + 1 AS last_rank FROM again GROUP BY year) y, (SELECT DISTINCT feature FROM again WHERE rank <= 3) f
LEFT JOIN again a ON a.year = y.year AND a.feature = f.feature""")
def attr_rank_evolution(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.importances(spark, folder).where("NOT (year % 2 = 0 AND feature = 'top')")
    return attribution.rank_evolution(df, 3)


@query("attr_trend_series", "year:i feature importance:r", _IMP + """
SELECT year, feature, importance FROM importances WHERE feature IN (SELECT feature FROM importances
  WHERE year = (SELECT max(year) FROM importances) ORDER BY importance DESC, feature LIMIT 3)""")
def attr_trend_series(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.importances(spark, folder)
    return attribution.trend_series(df, attribution.latest_year_top(df, 3))


@query("stream_completeness", "comp_id:i day:d missing", """
SELECT comp_id, day, concat_ws(',', CASE WHEN c = 0 THEN 'covariates' END, CASE WHEN h = 0 THEN 'history' END, CASE WHEN d = 0 THEN 'pd' END,
  CASE WHEN p = 0 THEN 'poe' END) AS missing
FROM (SELECT user_id AS comp_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS c, count(*) FILTER (event_type = 'click') AS h,
    count(*) FILTER (event_type = 'error') AS d, count(*) FILTER (event_type = 'signup') AS p FROM events GROUP BY ALL)""")
def stream_completeness(spark: SparkSession, folder: str) -> DataFrame:
    kinds = dict(zip(("view", "click", "error", "signup"), DROP_KINDS))
    kind = F.lit(None)
    for event_type, name in kinds.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    arrived = roles.table(spark, folder, "events").select(F.col("user_id").alias("comp_id"), F.to_date("ts").alias("day"), kind.alias("kind"))
    return missing_inputs(arrived, ["comp_id", "day"])
