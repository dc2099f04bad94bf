"""Projections, filters, windows, sorts and top-k over the panel and the prediction tables (P, W, A, T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.catalog.registry import query
from firmlens.functions import columns as c
from firmlens.functions.constants import COVARIATES, UNUSABLE_LABEL
from firmlens.operators import aggregates, attribution, joins, labels, prep
from firmlens.operators.ranges import exact_quantiles
from firmlens.plans import learn
from firmlens.session import stored
from firmlens.sources import roles

P = f"WITH {roles.PANEL_SQL} "
PRED = f"WITH {roles.PREDICTIONS_SQL} "


@query("prep_zero_fill", "firm:i ym:d liqfinlevel:r lqfintrend:r DTDmedianFin:r DTDmedianNonFin:r", P + """
SELECT firm, ym, coalesce(liqfinlevel, 0) AS liqfinlevel, coalesce(lqfintrend, 0) AS lqfintrend,
  coalesce(DTDmedianFin, 0) AS DTDmedianFin, DTDmedianNonFin FROM panel""")
def prep_zero_fill(spark: SparkSession, folder: str) -> DataFrame:
    return prep.fill_financial(roles.panel(spark, folder))


@query("prep_default_fill", "firm:i ym:d Y:i liqnonfinlevel:r liqnonfintrend:r liqfinlevel:r", P + """
SELECT firm, ym, Y, CASE WHEN Y = 1 THEN coalesce(liqnonfinlevel, 0) ELSE liqnonfinlevel END AS liqnonfinlevel,
  CASE WHEN Y = 1 THEN coalesce(liqnonfintrend, 0) ELSE liqnonfintrend END AS liqnonfintrend,
  CASE WHEN Y = 1 THEN coalesce(liqfinlevel, 0) ELSE liqfinlevel END AS liqfinlevel FROM panel""")
def prep_default_fill(spark: SparkSession, folder: str) -> DataFrame:
    return prep.fill_defaulted(roles.panel(spark, folder), "Y")


@query("prep_drop_sentinel", "firm:i ym:d marked:f", P + """
SELECT * FROM (SELECT firm, ym, CASE WHEN n_orders > 1 THEN 100 WHEN dummySOE = 0 THEN Y END AS marked FROM panel)
WHERE marked IS NULL OR marked <> 100""")
def prep_drop_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    marked = F.when(F.col("n_orders") > 1, UNUSABLE_LABEL).when(F.col("dummySOE") == 0, F.col("Y"))
    return prep.drop_unusable(roles.panel(spark, folder).withColumn("marked", marked), "marked")


@query("prep_known_outcome", "econ:i firm:i yyyymm:i is_default_1m:i", f"WITH {roles.OUTCOMES_SQL} " + """
SELECT econ, firm, year(ym) * 100 + month(ym) AS yyyymm, is_default AS is_default_1m FROM outcomes WHERE is_default <> -1""")
def prep_known_outcome(spark: SparkSession, folder: str) -> DataFrame:
    known = prep.known_outcomes(roles.outcome_predictions(spark, folder), "is_default_1m")
    return prep.known_outcomes(known, "is_default_12m")


@query("prep_drop_null_subset", "firm:i ym:d liqfinlevel:r Y:i", P + """
SELECT firm, ym, liqfinlevel, Y FROM panel WHERE liqfinlevel IS NOT NULL AND Y IS NOT NULL""")
def prep_drop_null_subset(spark: SparkSession, folder: str) -> DataFrame:
    return prep.drop_missing(roles.panel(spark, folder), ["liqfinlevel", "Y"])


@query("prep_date_from_parts", "firm:i year:i month:i first_day:d", P + """
SELECT firm, year, month, make_date(year, month, 1) AS first_day FROM panel""")
def prep_date_from_parts(spark: SparkSession, folder: str) -> DataFrame:
    return roles.panel(spark, folder).withColumn("first_day", c.month_of("year", "month"))


@query("prep_date_parse", "event_id:i from_day:d from_month:d from_text:d", """
SELECT event_id, CAST(ts AS DATE) AS from_day, CAST(date_trunc('month', ts) AS DATE) AS from_month, CAST(ts AS DATE) AS from_text
FROM events""")
def prep_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = roles.table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyyMMdd").cast("int").alias("day"),
        F.date_format("ts", "yyyyMM").cast("int").alias("month"),
        F.date_format("ts", "yyyy-MM-dd").alias("text"),
    )
    return raw.select(
        "event_id",
        c.date_from_ints("day").alias("from_day"),
        c.date_from_ints("month", "yyyyMM").alias("from_month"),
        c.date_from_ints("text", "yyyy-MM-dd").alias("from_text"),
    )


@query("prep_date_format", "comp_id:i day_text", PRED + "SELECT comp_id, strftime(yyyymmdd, '%Y-%m-%d') AS day_text FROM stats")
def prep_date_format(spark: SparkSession, folder: str) -> DataFrame:
    return roles.stat_predictions(spark, folder).select("comp_id", F.date_format("yyyymmdd", "yyyy-MM-dd").alias("day_text"))


@query("prep_feature_select", "firm:i ym:d " + " ".join(f"{f}:r" for f in COVARIATES),
       P + f", {roles.LINES_SQL} SELECT firm, ym, {', '.join(COVARIATES)} FROM panel LEFT JOIN lines USING (firm, ym)")
def prep_feature_select(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.panel(spark, folder, lines=True)
    return df.select("firm", "ym", *prep.feature_columns(df, [], fixed=True))


@query("prep_lpad_date", "comp_id:i text", PRED + """
SELECT comp_id, concat(lpad(CAST(yy % 100 AS VARCHAR), 4, '20'), '-', lpad(CAST(mm AS VARCHAR), 2, '0'), '-',
  lpad(CAST(dd AS VARCHAR), 2, '0')) AS text FROM stats""")
def prep_lpad_date(spark: SparkSession, folder: str) -> DataFrame:
    short = roles.stat_predictions(spark, folder).withColumn("yy", F.col("yy") % 100)
    return short.select("comp_id", c.padded_date_text("yy", "mm", "dd").alias("text"))


@query("proj_rename_predictions", "comp_id:i yyyy:i mm:i yyyymmdd:d pd_1:r poe_1:r",
       PRED + "SELECT comp_id, yyyy, mm, yyyymmdd, pd_1, poe_1 FROM model")
def proj_rename_predictions(spark: SparkSession, folder: str) -> DataFrame:
    raw = roles.model_predictions(spark, folder).withColumnsRenamed(
        {"comp_id": "Comp_No", "yyyy": "YYYY", "mm": "MM", "yyyymmdd": "YYYYMMDD"}
    )
    names = {"Comp_No": "comp_id", "YYYY": "yyyy", "MM": "mm", "YYYYMMDD": "yyyymmdd", "pd_1": "pd_1", "poe_1": "poe_1"}
    return prep.renamed_predictions(raw, names)


@query("proj_stamp_columns", "comp_id:i yyyymmdd:d econ:i horizon:i operation_date", PRED + """
SELECT comp_id, yyyymmdd, 2 AS econ, 12 AS horizon, '2024-02-01' AS operation_date FROM stats""")
def proj_stamp_columns(spark: SparkSession, folder: str) -> DataFrame:
    return prep.stamped(roles.stat_predictions(spark, folder), econ=2, horizon=12, operation_date="2024-02-01")


@query("proj_event_description", "comp_id:i yyyymmdd:d event_description", PRED + """
SELECT comp_id, yyyymmdd, CASE WHEN event_type IS NULL THEN 'NaN' WHEN event_type = 0 THEN 'No Default'
  WHEN event_type = 1 THEN 'Default' WHEN event_type = 2 THEN 'Exit the Market' ELSE 'Unknown' END AS event_description
FROM (SELECT comp_id, yyyymmdd, CASE WHEN comp_id % 7 = 0 THEN event_type + 2 ELSE event_type END AS event_type FROM truth)""")
def proj_event_description(spark: SparkSession, folder: str) -> DataFrame:
    code = F.when(F.col("comp_id") % 7 == 0, F.col("event_type") + 2).otherwise(F.col("event_type"))
    # Missing codes come as NULL and, for every other firm, as the text that other operators write for them.
    code = F.when(code.isNull() & (F.col("comp_id") % 2 == 0), "NaN").otherwise(code.cast("string"))
    return roles.ground_truth(spark, folder).select("comp_id", "yyyymmdd", c.event_description(code).alias("event_description"))


def _moved_date_sql(sign: str) -> str:
    return PRED + f"""
SELECT comp_id, yyyymmdd, CASE WHEN day(yyyymmdd {sign} INTERVAL 1 MONTH) = day(yyyymmdd)
  THEN strftime(yyyymmdd {sign} INTERVAL 1 MONTH, '%Y-%m-%d') ELSE 'N/A' END AS moved FROM stats"""


@query("proj_forecast_date", "comp_id:i yyyymmdd:d moved", _moved_date_sql("+"))
def proj_forecast_date(spark: SparkSession, folder: str) -> DataFrame:
    return prep.with_forecast_date(roles.stat_predictions(spark, folder), name="moved")


@query("proj_past_date", "comp_id:i yyyymmdd:d moved", _moved_date_sql("-"))
def proj_past_date(spark: SparkSession, folder: str) -> DataFrame:
    return roles.stat_predictions(spark, folder).withColumn("moved", c.subtract_one_month_text("yyyymmdd"))


@query("proj_binarise_label", "firm:i ym:d flag:i", P + "SELECT firm, ym, CASE WHEN Y = 1 THEN 1 ELSE 0 END AS flag FROM panel")
def proj_binarise_label(spark: SparkSession, folder: str) -> DataFrame:
    return roles.panel(spark, folder).select("firm", "ym", c.as_default_flag("Y").alias("flag"))


@query("proj_argmax_class", "firm:i ym:d yhat:i", f"WITH {roles.SCORED_SQL} " + """
SELECT firm, ym, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS yhat FROM scored""")
def proj_argmax_class(spark: SparkSession, folder: str) -> DataFrame:
    scored = roles.three_class_scores(roles.panel(spark, folder))
    return scored.select("firm", "ym", c.argmax_class("p").alias("yhat"))


@query("filt_company_search", "c_custkey:i c_name c_mktsegment", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE contains(lower(c_name), 'build') OR contains(lower(c_mktsegment), 'build') OR c_nationkey = 3""")
def filt_company_search(spark: SparkSession, folder: str) -> DataFrame:
    info = roles.table(spark, folder, "customer").withColumn("ticker", F.when(F.col("c_nationkey") == 3, "Rebuild"))
    return prep.search_text(info, "BUILD", ["c_name", "c_mktsegment", "ticker"])


@query("filt_company_slice", "source comp_id:i yyyymmdd:d", PRED + """
SELECT 'stats' AS source, comp_id, yyyymmdd FROM stats WHERE comp_id = 8
UNION ALL SELECT 'model', comp_id, yyyymmdd FROM model WHERE comp_id = 8
UNION ALL SELECT 'truth', comp_id, yyyymmdd FROM truth WHERE comp_id = 8""")
def filt_company_slice(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"stats": roles.stat_predictions, "model": roles.model_predictions, "truth": roles.ground_truth}
    out = None
    for name, source in sources.items():
        part = source(spark, folder).where("comp_id = 8").select(F.lit(name).alias("source"), "comp_id", "yyyymmdd")
        out = part if out is None else out.unionByName(part)
    return out


def backtest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Stored backtest rows per (econ, horizon, month), with missing metrics where a month has no default."""
    counts = roles.panel(spark, folder).groupBy("econ", F.col("ym").alias("date")).agg(
        F.count(F.lit(1)).alias("test_size"), F.count_if(F.col("Y") == 1).alias("test_positives"),
        F.sum(F.col("cents") % 101).alias("a"), F.sum(F.col("cents") % 103).alias("b"),
    )
    counts = counts.withColumns({
        "auc_score": F.when(F.col("test_positives") > 0, F.col("a") / (101 * F.col("test_size"))),
        "pr_auc": F.when(F.col("test_size") > 1, F.col("b") / (103 * F.col("test_size"))),
        "horizon": F.when(F.col("test_size") % 2 == 0, 12).otherwise(1),
    })
    return counts.drop("a", "b")


BACKTEST_SQL = roles.PANEL_SQL + """,
backtest AS (SELECT econ, ym AS date, test_size, test_positives,
    CASE WHEN test_positives > 0 THEN a / (101 * test_size) END AS auc_score,
    CASE WHEN test_size > 1 THEN b / (103 * test_size) END AS pr_auc,
    CASE WHEN test_size % 2 = 0 THEN 12 ELSE 1 END AS horizon
  FROM (SELECT econ, ym, count(*) AS test_size, CAST(sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS test_positives,
      CAST(sum(cents % 101) AS BIGINT) AS a, CAST(sum(cents % 103) AS BIGINT) AS b FROM panel GROUP BY econ, ym))"""
B = f"WITH {BACKTEST_SQL} "


@query("filt_econ_horizon_scored", "date:d auc_score:r pr_auc:r test_positives:i", B + """
SELECT date, auc_score, pr_auc, test_positives FROM backtest
WHERE econ = 2 AND horizon = 1 AND (auc_score IS NOT NULL OR pr_auc IS NOT NULL) ORDER BY date""")
def filt_econ_horizon_scored(spark: SparkSession, folder: str) -> DataFrame:
    return prep.scored_series(backtest_rows(spark, folder), 2, 1)


# Windows -----------------------------------------------------------------------------------------


@query("win_lead_label_12", "firm:i ym:d Y:f", P + """
SELECT firm, ym, lead(Y, 12) OVER (PARTITION BY firm ORDER BY ym) AS Y FROM panel""")
def win_lead_label_12(spark: SparkSession, folder: str) -> DataFrame:
    return labels.lead_label(roles.panel(spark, folder), 12)


@query("win_lead_label_1", "firm:i ym:d Y:i", P + """
SELECT firm, ym, Y13 AS Y FROM (SELECT firm, ym, lead(Y, 13) OVER (PARTITION BY firm ORDER BY ym) AS Y13 FROM panel)
WHERE Y13 IS NOT NULL""")
def win_lead_label_1(spark: SparkSession, folder: str) -> DataFrame:
    return labels.lead_label_known(labels.lead_label(roles.panel(spark, folder), 12), 1)


@query("win_lead_label_calendar", "firm:i ym:d Y_ahead:f", P + """
SELECT a.firm, a.ym, b.Y AS Y_ahead FROM panel a LEFT JOIN panel b ON a.firm = b.firm AND b.ym = CAST(a.ym + INTERVAL 12 MONTH AS DATE)""")
def win_lead_label_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return labels.lead_label_calendar(roles.panel(spark, folder), 12)


@query("win_current_previous_event", "comp_id:i task_date:d current_date current_event_type previous_date previous_event_type", PRED + """,
ranked AS (SELECT comp_id, task_date, CAST(yyyymmdd AS VARCHAR) AS day, coalesce(CAST(event_type AS VARCHAR), 'NaN') AS kind,
    row_number() OVER (PARTITION BY comp_id, task_date ORDER BY yyyymmdd DESC) AS n FROM truth)
SELECT comp_id, task_date, max(CASE WHEN n = 1 THEN day END) AS current_date, max(CASE WHEN n = 1 THEN kind END) AS current_event_type,
  coalesce(max(CASE WHEN n = 2 THEN day END), 'NaN') AS previous_date,
  coalesce(max(CASE WHEN n = 2 THEN kind END), 'NaN') AS previous_event_type
FROM ranked GROUP BY comp_id, task_date""")
def win_current_previous_event(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.current_and_previous(roles.ground_truth(spark, folder), ["comp_id", "task_date"], "yyyymmdd", "event_type")


@query("win_ffill_bfill", "firm:i ym:d grade", P + """,
graded AS (SELECT firm, ym, CASE WHEN n_orders > 1 THEN concat('g', CAST(month AS VARCHAR)) END AS g FROM panel)
SELECT firm, ym, coalesce(
  last_value(g IGNORE NULLS) OVER (PARTITION BY firm ORDER BY ym ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(g IGNORE NULLS) OVER (PARTITION BY firm ORDER BY ym ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS grade
FROM graded""")
def win_ffill_bfill(spark: SparkSession, folder: str) -> DataFrame:
    grade = F.when(F.col("n_orders") > 1, F.concat(F.lit("g"), F.col("month").cast("string")))
    return labels.fill_along(roles.panel(spark, folder).withColumn("grade", grade), ["grade"], ["firm"], ["ym"])


@query("win_latest_record", "comp_id:i yyyymmdd:d task_date:d stats_pd_1:r ml_pd_1:r", PRED + """,
merged AS (SELECT coalesce(s.comp_id, m.comp_id) AS comp_id, coalesce(s.yyyymmdd, m.yyyymmdd) AS yyyymmdd,
    coalesce(s.task_date, m.task_date) AS task_date, s.pd_1 AS stats_pd_1, m.pd_1 AS ml_pd_1
  FROM stats s FULL JOIN model m ON s.comp_id = m.comp_id AND s.yyyymmdd = m.yyyymmdd)
SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY yyyymmdd DESC) AS n FROM merged) WHERE n = 1""")
def win_latest_record(spark: SparkSession, folder: str) -> DataFrame:
    merged = joins.merged_predictions(
        roles.stat_predictions(spark, folder), roles.model_predictions(spark, folder), roles.ground_truth(spark, folder)
    )
    return aggregates.latest_per_key(merged, ["comp_id"], [F.col("yyyymmdd").desc(), F.col("task_date").desc()])


_IMP = f"WITH {roles.IMPORTANCE_SQL} "


@query("win_feature_rank", "year:i feature rank:i importance:r", _IMP + """
SELECT * FROM (SELECT year, feature, importance, row_number() OVER (PARTITION BY year ORDER BY importance DESC, feature) AS rank
  FROM importances) WHERE rank <= 4""")
def win_feature_rank(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.ranked_features(roles.importances(spark, folder), 4)


def _rolling_sql() -> str:
    frame = lambda k: f"OVER (PARTITION BY econ ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    parts = [f"CASE WHEN count(pr_auc) {frame(k)} = {k} THEN avg(pr_auc) {frame(k)} END AS mean_{k}" for k in (3, 6, 12)]
    parts.append(f"CASE WHEN count(*) {frame(12)} = 12 THEN sum(test_positives) {frame(12)} END AS positives_12")
    return B + f"SELECT econ, date, {', '.join(parts)} FROM backtest"


@query("win_rolling_metrics", "econ:i date:d mean_3:r mean_6:r mean_12:r positives_12:f", _rolling_sql())
def win_rolling_metrics(spark: SparkSession, folder: str) -> DataFrame:
    df = backtest_rows(spark, folder)
    for k in (3, 6, 12):
        df = labels.rolling_mean(df, "pr_auc", k, ["econ"], ["date"], f"mean_{k}")
    return labels.rolling_sum(df, "test_positives", 12, ["econ"], ["date"], "positives_12")


@query("win_expanding_train_size", "econ:i ym:d n_rows:i train_size:i", P + """,
monthly AS (SELECT econ, ym, count(*) AS n_rows FROM panel GROUP BY econ, ym)
SELECT econ, ym, n_rows, coalesce(sum(n_rows) OVER (PARTITION BY econ ORDER BY ym ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS train_size
FROM monthly""")
def win_expanding_train_size(spark: SparkSession, folder: str) -> DataFrame:
    monthly = roles.panel(spark, folder).groupBy("econ", "ym").agg(F.count(F.lit(1)).alias("n_rows"))
    return aggregates.window_sizes(monthly, ["econ"])


# Aggregations ------------------------------------------------------------------------------------


@query("agg_latest_per_firm", "firm:i ym:d sizelevel:r Y:i", P + """
SELECT firm, ym, sizelevel, Y FROM (SELECT *, row_number() OVER (PARTITION BY firm ORDER BY ym DESC) AS n FROM panel) WHERE n = 1""")
def agg_latest_per_firm(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.latest_per_key(roles.panel(spark, folder), ["firm"], [F.col("ym").desc()])


@query("agg_distinct_companies", "comp_id:i n_companies:i", PRED + """
SELECT DISTINCT comp_id, (SELECT count(DISTINCT comp_id) FROM stats) AS n_companies FROM stats ORDER BY comp_id""")
def agg_distinct_companies(spark: SparkSession, folder: str) -> DataFrame:
    stats = roles.stat_predictions(spark, folder)
    total = stats.agg(F.count_distinct("comp_id").alias("n"))
    return aggregates.distinct_sorted(stats, "comp_id").withColumn("n_companies", total.scalar())


@query("agg_class_counts", "year:i n_classes:i classes n_rows:i", P + """
SELECT year, count(DISTINCT Y) AS n_classes, string_agg(DISTINCT CAST(Y AS VARCHAR), ',' ORDER BY CAST(Y AS VARCHAR)) AS classes,
  count(*) AS n_rows FROM panel GROUP BY year""")
def agg_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.class_counts(roles.panel(spark, folder), ["year"])


@query("agg_class_weights", "econ:i Y:i n_class:i weight:r rows_weighted:r", P + """,
counts AS (SELECT econ, Y, count(*) AS n_class FROM panel GROUP BY econ, Y),
weights AS (SELECT *, sum(n_class) OVER (PARTITION BY econ) / (count(*) OVER (PARTITION BY econ) * n_class) AS weight FROM counts)
SELECT econ, Y, n_class, weight, n_class * weight AS rows_weighted FROM weights""")
def agg_class_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = aggregates.weighted_rows(roles.panel(spark, folder), "Y", ["econ"])
    return rows.groupBy("econ", "Y").agg(
        F.count(F.lit(1)).alias("n_class"), F.max("weight").alias("weight"), F.sum("weight").alias("rows_weighted")
    )


@query("agg_series_summary", "horizon:i n_dates:i " + " ".join(f"{m}_{s}:r" for m in ("auc", "pr") for s in ("mean_1", "std_1", "mean_2", "std_2", "corr")), B + """,
a AS (SELECT * FROM backtest WHERE econ % 2 = 0), b AS (SELECT * FROM backtest WHERE econ % 2 = 1 AND auc_score IS NOT NULL)
SELECT horizon, count(*) AS n_dates, avg(x1) AS auc_mean_1, stddev_samp(x1) AS auc_std_1, avg(x2) AS auc_mean_2, stddev_samp(x2) AS auc_std_2,
  corr(x1, x2) AS auc_corr, avg(y1) AS pr_mean_1, stddev_samp(y1) AS pr_std_1, avg(y2) AS pr_mean_2, stddev_samp(y2) AS pr_std_2, corr(y1, y2) AS pr_corr
FROM (SELECT a.horizon, a.auc_score AS x1, b.auc_score AS x2, a.pr_auc AS y1, b.pr_auc AS y2
  FROM a JOIN b ON a.econ + 1 = b.econ AND a.date = b.date AND a.horizon = b.horizon) GROUP BY horizon""")
def agg_series_summary(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.series_summary(
        compared_series(spark, folder),
        {"auc": ("auc_score_model1", "auc_score_model2"), "pr": ("pr_auc_model1", "pr_auc_model2")}, ["horizon"],
    )


def compared_series(spark: SparkSession, folder: str) -> DataFrame:
    """Backtest rows of neighbouring economies as two models' series of one pair."""
    rows = backtest_rows(spark, folder).withColumn("pair", (F.col("econ") - F.col("econ") % 2).cast("int"))
    rows = rows.select("pair", "econ", "horizon", "date", "auc_score", "pr_auc")
    first, second = rows.where("econ % 2 = 0").drop("econ"), rows.where("econ % 2 = 1").drop("econ")
    return joins.model_comparison(first, second, ["pair", "horizon", "date"])


@query("agg_backtest_mean", "econ:i mean_auc_score:r mean_pr_auc:r", B + """
SELECT econ, avg(auc_score) AS mean_auc_score, avg(pr_auc) AS mean_pr_auc FROM backtest GROUP BY econ""")
def agg_backtest_mean(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.metric_means(backtest_rows(spark, folder), ["econ"], ["auc_score", "pr_auc"])


@query("agg_horizon_summary", "pair:i horizon:i mean_auc_score_model1:r mean_pr_auc_model1:r mean_auc_score_model2:r mean_pr_auc_model2:r", B + """
SELECT a.econ AS pair, a.horizon, avg(a.auc_score) AS mean_auc_score_model1, avg(a.pr_auc) AS mean_pr_auc_model1,
  avg(b.auc_score) AS mean_auc_score_model2, avg(b.pr_auc) AS mean_pr_auc_model2
FROM backtest a JOIN backtest b ON a.econ % 2 = 0 AND a.econ + 1 = b.econ AND a.date = b.date AND a.horizon = b.horizon
WHERE b.auc_score IS NOT NULL GROUP BY a.econ, a.horizon""")
def agg_horizon_summary(spark: SparkSession, folder: str) -> DataFrame:
    metrics = ["auc_score_model1", "pr_auc_model1", "auc_score_model2", "pr_auc_model2"]
    return aggregates.metric_means(compared_series(spark, folder), ["pair", "horizon"], metrics)


def _profile_sql() -> str:
    cols = ["sizelevel", "sizetrend", "liqfinlevel", "m2b"]
    longs = " UNION ALL ".join(f'SELECT year <= 1999 AS train, \'{n}\' AS "column", CAST({n} AS DOUBLE) AS x FROM panel' for n in cols)
    stats = {
        "count": "CAST(count(x) AS DOUBLE)", "missing": "CAST(count(*) - count(x) AS DOUBLE)", "distinct": "CAST(count(DISTINCT x) AS DOUBLE)",
        "mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)", "q25": "quantile_cont(x, 0.25)", "q50": "quantile_cont(x, 0.5)",
        "q75": "quantile_cont(x, 0.75)", "max": "max(x)",
    }
    parts = " UNION ALL ".join(f'SELECT part, "column", \'{s}\' AS stat, {e} AS value FROM long GROUP BY part, "column"' for s, e in stats.items())
    return P + f""", long AS (SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, "column", x FROM ({longs})) {parts}"""


@query("agg_data_profile", "part column stat value:r", _profile_sql())
def agg_data_profile(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.panel(spark, folder).withColumn("part", F.when(F.col("year") <= 1999, "train").otherwise("test"))
    return aggregates.data_profile(df, ["part"], ["sizelevel", "sizetrend", "liqfinlevel", "m2b"])


_PROFILED = ["sizelevel", "sizetrend", "liqfinlevel", "m2b"]


@query("agg_profile_merged", "part column n:i missing:i mean:r std:r min:r max:r quartiles_close:i distinct_close:i", P + """, long AS (""" + " UNION ALL ".join(
    f"SELECT CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS part, '{n}' AS \"column\", CAST({n} AS DOUBLE) AS x FROM panel" for n in _PROFILED) + """)
SELECT part, "column", count(x) AS n, count(*) - count(x) AS missing, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, max(x) AS max,
  true AS quartiles_close, true AS distinct_close FROM long GROUP BY ALL""")
def agg_profile_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of both parts from sketches per economy and month, held against the exact one."""
    df = roles.panel(spark, folder)
    part = F.when(F.year("ym") <= 1999, "train").otherwise("test")
    merged = aggregates.merged_profile(stored(aggregates.profile_parts(df, ["econ", "ym"], _PROFILED)).withColumn("part", part), ["part"])
    wide = merged.groupBy("part", "column").pivot("stat", ["count", "missing", "distinct", "mean", "std", "min", "q25", "q50", "q75", "max"]).agg(F.first("value"))
    long = df.select(part.alias("part"), *_PROFILED).unpivot(["part"], _PROFILED, "column", "x")
    around = {f"{side}{q}": q / 100 + shift for q in (25, 50, 75) for side, shift in (("lo", -0.01), ("hi", 0.01))}
    exact = exact_quantiles(long, ["part", "column"], "x", around, distinct="values")
    close = F.col("q25").between(F.col("lo25"), F.col("hi25")) & F.col("q50").between(F.col("lo50"), F.col("hi50")) & F.col("q75").between(F.col("lo75"), F.col("hi75"))
    return wide.join(exact, ["part", "column"]).select(
        "part", "column", F.col("count").alias("n"), "missing", "mean", "std", "min", "max",
        close.alias("quartiles_close"), (F.abs(F.col("distinct") - F.col("values")) <= 0.025 * F.col("values")).alias("distinct_close"),
    )


# Sorts and top-k ---------------------------------------------------------------------------------


@query("sort_by_date", "firm:i ym:d Y:i", P + "SELECT firm, ym, Y FROM panel ORDER BY ym, firm")
def sort_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return roles.panel(spark, folder).orderBy("ym", "firm")


@query("sort_multi_key", "comp_id:i yyyymmdd:d event_type:f", PRED + "SELECT comp_id, yyyymmdd, event_type FROM truth ORDER BY comp_id, yyyymmdd DESC")
def sort_multi_key(spark: SparkSession, folder: str) -> DataFrame:
    return roles.ground_truth(spark, folder).orderBy("comp_id", F.col("yyyymmdd").desc())


@query("topk_features", "source feature importance:r", _IMP + """
SELECT * FROM (SELECT 'mean' AS source, feature, avg(importance) AS importance FROM importances GROUP BY feature ORDER BY importance DESC, feature LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'latest', feature, importance FROM importances WHERE year = (SELECT max(year) FROM importances)
  ORDER BY importance DESC, feature LIMIT 3)""")
def topk_features(spark: SparkSession, folder: str) -> DataFrame:
    df = roles.importances(spark, folder)
    mean = attribution.top_mean_features(df, 5).select(F.lit("mean").alias("source"), "feature", F.col("mean_importance").alias("importance"))
    latest = attribution.latest_year_top(df, 3).select(F.lit("latest").alias("source"), "feature", "importance")
    return mean.unionByName(latest)


@query("topk_union_over_years", "feature", _IMP + """
SELECT DISTINCT feature FROM (SELECT feature, row_number() OVER (PARTITION BY year ORDER BY importance DESC, feature) AS n FROM importances) WHERE n <= 3""")
def topk_union_over_years(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.top_union(roles.importances(spark, folder), 3)


@query("pick_best_params", "econ:i best_by_loss:d best_by_auc:d", B + """
SELECT econ, arg_min(date, pr_auc + CAST(year(date) * 12 + month(date) AS DOUBLE) / 1e6) AS best_by_loss,
  arg_max(date, auc_score + CAST(year(date) * 12 + month(date) AS DOUBLE) / 1e6) AS best_by_auc
FROM backtest GROUP BY econ""")
def pick_best_params(spark: SparkSession, folder: str) -> DataFrame:
    late = (F.year("date") * 12 + F.month("date")).cast("double") / 1e6
    rows = backtest_rows(spark, folder).select("econ", F.col("date").alias("settings"), (F.col("pr_auc") + late).alias("loss"), (F.col("auc_score") + late).alias("gain"))
    least = learn.best_settings(rows, loss="loss", keys=["econ"]).withColumnRenamed("settings", "best_by_loss")
    return least.join(learn.best_settings(rows, gain="gain", keys=["econ"]).withColumnRenamed("settings", "best_by_auc"), "econ")
