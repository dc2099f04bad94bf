"""The engine's input tables, derived from a folder of generic order / event / embedding tables.

Each function returns one role of the data model (firm-month panel, predictions, ground truth ...). All
sums are over whole cents, so results do not depend on the order in which rows are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firmlens.functions.constants import HORIZONS


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; its schema is read from the files once, not for every use."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def cents(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("long")


def panel(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """Firm-month panel: (econ, firm, ym, year, month, covariates, Y), one row per firm and month.

    Orders are reduced to firm-months before they meet the customer table, so a firm that owns a third
    of all orders is already down to one row per month when it is shuffled by firm. ``lines`` adds the
    two covariates that need the line items.
    """
    orders = table(spark, folder, "orders")
    sums = [
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(cents("o_totalprice")).alias("cents"),
        F.max(cents("o_totalprice")).alias("max_cents"),
        F.min(cents("o_totalprice")).alias("min_cents"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("any_default"),
        F.bool_or(F.col("o_orderstatus") == "P").alias("any_exit"),
    ]
    if lines:
        per_order = (
            table(spark, folder, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.sum(F.col("l_quantity").cast("long")).alias("qty"),
                F.sum(cents("l_discount")).alias("disc"),
            )
        )
        orders = orders.join(per_order, "o_orderkey", "left")
        sums += [F.sum(c).alias(c) for c in ("n_lines", "qty", "disc")]
    firm_months = orders.groupBy(
        F.col("o_custkey").alias("firm"), F.trunc("o_orderdate", "month").alias("ym")
    ).agg(*sums)
    firms = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("firm"),
        F.col("c_nationkey").alias("econ"),
        cents("c_acctbal").alias("acct"),
        F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING").alias("fin"),
    )
    df = firm_months.join(firms, "firm")
    fin, other = F.col("fin"), ~F.col("fin")
    ratio = lambda a, b: F.col(a) / F.col(b)
    out = [
        F.col("econ"), F.col("firm"), F.col("ym"),
        F.year("ym").alias("year"), F.month("ym").alias("month"),
        (F.year("ym") - 1995).cast("double").alias("StkIndx"),
        (F.month("ym") / 12).alias("STInt"),
        (F.col("acct") / 100).alias("ni2talevel"),
        ratio("acct", "cents").alias("ni2tatrend"),
        (ratio("cents", "n_orders") / 100).alias("sizelevel"),
        ((F.col("max_cents") - F.col("min_cents")) / 100).alias("sizetrend"),
        ratio("urgent", "n_orders").alias("m2b"),
        ratio("max_cents", "cents").alias("sigma"),
        F.when(fin, F.col("min_cents") / 100).alias("liqfinlevel"),
        F.when(fin, F.col("n_orders").cast("double")).alias("lqfintrend"),
        F.when(fin, ratio("min_cents", "max_cents")).alias("DTDmedianFin"),
        F.when(other, F.col("min_cents") / 100).alias("liqnonfinlevel"),
        F.when(other, F.col("n_orders").cast("double")).alias("liqnonfintrend"),
        F.when(other, ratio("min_cents", "max_cents")).alias("DTDmedianNonFin"),
        (F.col("econ") % 2).cast("double").alias("dummySOE"),
        F.col("n_orders"), F.col("cents"), F.col("max_cents"), F.col("min_cents"),
        F.when(F.col("any_default"), 1).when(F.col("any_exit"), 2).otherwise(0).alias("Y"),
    ]
    if lines:
        out += [ratio("qty", "n_lines").alias("dtdlevel"), ratio("disc", "n_lines").alias("dtdtrend")]
    return df.select(*out)


# The same panel as text for side-by-side checks.
PANEL_SQL = """
base AS (
  SELECT o_custkey AS firm, CAST(date_trunc('month', o_orderdate) AS DATE) AS ym, count(*) AS n_orders,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
    max(CAST(round(o_totalprice * 100) AS BIGINT)) AS max_cents,
    min(CAST(round(o_totalprice * 100) AS BIGINT)) AS min_cents,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent,
    CASE WHEN max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 1
         WHEN max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 1 THEN 2 ELSE 0 END AS Y
  FROM orders GROUP BY 1, 2),
firms AS (
  SELECT c_custkey AS firm, c_nationkey AS econ, CAST(round(c_acctbal * 100) AS BIGINT) AS acct,
    c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS fin FROM customer),
panel AS (
  SELECT f.econ, b.firm, b.ym, CAST(year(b.ym) AS INT) AS year, CAST(month(b.ym) AS INT) AS month,
    CAST(year(b.ym) - 1995 AS DOUBLE) AS StkIndx, month(b.ym) / 12 AS STInt,
    f.acct / 100 AS ni2talevel, f.acct / b.cents AS ni2tatrend,
    (b.cents / b.n_orders) / 100 AS sizelevel, (b.max_cents - b.min_cents) / 100 AS sizetrend,
    b.urgent / b.n_orders AS m2b, b.max_cents / b.cents AS sigma,
    CASE WHEN fin THEN b.min_cents / 100 END AS liqfinlevel,
    CASE WHEN fin THEN CAST(b.n_orders AS DOUBLE) END AS lqfintrend,
    CASE WHEN fin THEN b.min_cents / b.max_cents END AS DTDmedianFin,
    CASE WHEN NOT fin THEN b.min_cents / 100 END AS liqnonfinlevel,
    CASE WHEN NOT fin THEN CAST(b.n_orders AS DOUBLE) END AS liqnonfintrend,
    CASE WHEN NOT fin THEN b.min_cents / b.max_cents END AS DTDmedianNonFin,
    CAST(f.econ % 2 AS DOUBLE) AS dummySOE, b.n_orders, b.cents, b.max_cents, b.min_cents, b.Y
  FROM base b JOIN firms f ON b.firm = f.firm)"""

# The two covariates that need the line items, to be joined by firm and month.
LINES_SQL = """
per_order AS (
  SELECT l_orderkey AS o_orderkey, count(*) AS n_lines, sum(CAST(l_quantity AS BIGINT)) AS qty,
    sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc FROM lineitem GROUP BY 1),
lines AS (
  SELECT o_custkey AS firm, CAST(date_trunc('month', o_orderdate) AS DATE) AS ym, sum(qty) / sum(n_lines) AS dtdlevel,
    sum(disc) / sum(n_lines) AS dtdtrend FROM orders LEFT JOIN per_order USING (o_orderkey) GROUP BY 1, 2)"""


def three_class_scores(df: DataFrame) -> DataFrame:
    """Adds p0, p1, p2 (a stored three-class score that sums to 1 and has ties) and the array ``p``."""
    weights = df.withColumns(
        {"a_": 1 + F.col("cents") % 23, "b_": 1 + F.col("max_cents") % 19, "c_": 1 + F.col("min_cents") % 17}
    )
    total = F.col("a_") + F.col("b_") + F.col("c_")
    parts = weights.withColumns({f"p{i}": F.col(c) / total for i, c in enumerate(("a_", "b_", "c_"))})
    return parts.withColumn("p", F.array("p0", "p1", "p2")).drop("a_", "b_", "c_")


SCORED_SQL = (
    PANEL_SQL
    + """,
weights AS (SELECT *, 1 + cents % 23 AS a_, 1 + max_cents % 19 AS b_, 1 + min_cents % 17 AS c_ FROM panel),
scored AS (SELECT *, a_ / (a_ + b_ + c_) AS p0, b_ / (a_ + b_ + c_) AS p1, c_ / (a_ + b_ + c_) AS p2 FROM weights)"""
)


def firm_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events reduced to one row per (comp_id, day): cents per event type and whether the type occurred."""
    kinds = ["view", "click", "purchase", "error", "signup"]
    sums = []
    for kind in kinds:
        hit = F.col("event_type") == kind
        sums += [F.sum(F.when(hit, cents("value"))).alias(f"c_{kind}"), F.count_if(hit).alias(f"n_{kind}")]
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("comp_id"), F.to_date("ts").alias("day"))
        .agg(*sums)
        .withColumn("task_date", F.date_add(F.trunc("day", "week"), 7))
    )


FIRM_DAYS_SQL = """
firm_days AS (
  SELECT user_id AS comp_id, CAST(ts AS DATE) AS day,
    CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) + 7 AS task_date,
    CAST(sum(CASE WHEN event_type = 'view' THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS c_view,
    CAST(sum(CASE WHEN event_type = 'click' THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS c_click,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS c_purchase,
    CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS n_view,
    CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS n_click,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS n_purchase,
    CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_error,
    CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS n_signup
  FROM events GROUP BY 1, 2, 3)"""


def stat_pd(spark: SparkSession, folder: str) -> DataFrame:
    """Default term structure rows: days with views."""
    return firm_days(spark, folder).where("n_view > 0").select(
        "comp_id", *_day_parts(), *[((F.col("c_view") * h) % 9973 / 9973).alias(f"pd_{h}") for h in HORIZONS], "task_date"
    )


def stat_poe(spark: SparkSession, folder: str) -> DataFrame:
    """Exit term structure rows: days with purchases."""
    return firm_days(spark, folder).where("n_purchase > 0").select(
        "comp_id", *_day_parts(), *[((F.col("c_purchase") * h) % 9967 / 9967).alias(f"poe_{h}") for h in HORIZONS]
    )


def _day_parts() -> list[Column]:
    return [F.year("day").alias("yy"), F.month("day").alias("mm"), F.dayofmonth("day").alias("dd")]


STAT_SQL = (
    FIRM_DAYS_SQL
    + """,
stat_pd AS (SELECT comp_id, CAST(year(day) AS INT) AS yy, CAST(month(day) AS INT) AS mm, CAST(day(day) AS INT) AS dd, """
    + ", ".join(f"((c_view * {h}) % 9973) / 9973 AS pd_{h}" for h in HORIZONS)
    + """, task_date FROM firm_days WHERE n_view > 0),
stat_poe AS (SELECT comp_id, CAST(year(day) AS INT) AS yy, CAST(month(day) AS INT) AS mm, CAST(day(day) AS INT) AS dd, """
    + ", ".join(f"((c_purchase * {h}) % 9967) / 9967 AS poe_{h}" for h in HORIZONS)
    + """ FROM firm_days WHERE n_purchase > 0)"""
)


def stat_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stored statistical predictions of the one-month horizon: days with views."""
    return firm_days(spark, folder).where("n_view > 0").select(
        "comp_id", F.col("day").alias("yyyymmdd"), *_day_parts(),
        (F.col("c_view") % 9973 / 9973).alias("pd_1"),
        (F.col("c_view") * 7 % 9967 / 9967).alias("poe_1"),
        "task_date",
    )


def model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Stored model predictions: days with clicks."""
    return firm_days(spark, folder).where("n_click > 0").select(
        "comp_id", F.col("day").alias("yyyymmdd"), F.year("day").alias("yyyy"), F.month("day").alias("mm"),
        (F.col("c_click") % 9949 / 9949).alias("pd_1"),
        (F.col("c_click") * 7 % 9941 / 9941).alias("poe_1"),
        (F.col("comp_id") % 25).cast("int").alias("econ"),
        "task_date",
    )


def ground_truth(spark: SparkSession, folder: str) -> DataFrame:
    """Event per firm and day: 1 after an error, 2 after a signup, otherwise 0; days with views only have none."""
    code = F.when(F.col("n_error") > 0, 1).when(F.col("n_signup") > 0, 2).when(F.col("n_click") > 0, 0)
    return firm_days(spark, folder).select("comp_id", F.col("day").alias("yyyymmdd"), code.alias("event_type"), "task_date")


PREDICTIONS_SQL = (
    FIRM_DAYS_SQL
    + """,
stats AS (SELECT comp_id, day AS yyyymmdd, CAST(year(day) AS INT) AS yy, CAST(month(day) AS INT) AS mm,
    CAST(day(day) AS INT) AS dd, (c_view % 9973) / 9973 AS pd_1, (c_view * 7 % 9967) / 9967 AS poe_1, task_date
  FROM firm_days WHERE n_view > 0),
model AS (SELECT comp_id, day AS yyyymmdd, CAST(year(day) AS INT) AS yyyy, CAST(month(day) AS INT) AS mm,
    (c_click % 9949) / 9949 AS pd_1, (c_click * 7 % 9941) / 9941 AS poe_1, CAST(comp_id % 25 AS INT) AS econ, task_date
  FROM firm_days WHERE n_click > 0),
truth AS (SELECT comp_id, day AS yyyymmdd, CASE WHEN n_error > 0 THEN 1 WHEN n_signup > 0 THEN 2
    WHEN n_click > 0 THEN 0 END AS event_type, task_date FROM firm_days)"""
)


def outcome_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Statistical predictions with outcomes per firm-month: (econ, firm, yyyymm, pd_1m, pd_12m, is_default_1m,
    is_default_12m); -1 marks an outcome that is not known (an exit)."""
    flag = F.when(F.col("Y") == 2, -1).otherwise(F.col("Y"))
    return panel(spark, folder).select(
        "econ", "firm",
        (F.col("year") * 100 + F.col("month")).alias("yyyymm"),
        (F.col("cents") % 997 / 997).alias("pd_1m"),
        (F.col("max_cents") % 499 / 499).alias("pd_12m"),
        flag.alias("is_default_1m"),
        flag.alias("is_default_12m"),
    )


OUTCOMES_SQL = (
    PANEL_SQL
    + """,
outcomes AS (SELECT econ, firm, ym, (cents % 997) / 997 AS pd_1m, (max_cents % 499) / 499 AS pd_12m,
    CASE WHEN Y = 2 THEN -1 ELSE Y END AS is_default FROM panel)"""
)


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """(year, feature, importance): mean absolute deviation-free size of each numeric covariate per year,
    from whole-number sums over the whole panel."""
    df = panel(spark, folder)
    sums = df.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_orders").alias("orders"),
        F.sum(F.col("cents") % 1009).alias("cents"),
        F.sum(F.col("max_cents") % 1013).alias("top"),
        F.sum(F.col("min_cents") % 1019).alias("low"),
        F.sum("month").alias("month"),
        F.sum("econ").cast("long").alias("econ"),
        F.sum("Y").alias("label"),
    )
    return sums.unpivot(
        ["year", "n"], ["orders", "cents", "top", "low", "month", "econ", "label"], "feature", "total"
    ).select("year", "feature", (F.col("total") * F.when(F.col("feature").isin("orders", "label", "month", "econ"), 60).otherwise(1) / F.col("n")).alias("importance"))


IMPORTANCE_SQL = (
    PANEL_SQL
    + """,
sums AS (SELECT year, count(*) AS n, CAST(sum(n_orders) AS BIGINT) AS orders, CAST(sum(cents % 1009) AS BIGINT) AS cents,
    CAST(sum(max_cents % 1013) AS BIGINT) AS top, CAST(sum(min_cents % 1019) AS BIGINT) AS low,
    CAST(sum(month) AS BIGINT) AS month, CAST(sum(econ) AS BIGINT) AS econ, CAST(sum(Y) AS BIGINT) AS label
  FROM panel GROUP BY year),
importances AS (
  SELECT year, 'orders' AS feature, orders * 60 / n AS importance FROM sums UNION ALL
  SELECT year, 'cents', cents * 1 / n FROM sums UNION ALL
  SELECT year, 'top', top * 1 / n FROM sums UNION ALL
  SELECT year, 'low', low * 1 / n FROM sums UNION ALL
  SELECT year, 'month', month * 60 / n FROM sums UNION ALL
  SELECT year, 'econ', econ * 60 / n FROM sums UNION ALL
  SELECT year, 'label', label * 60 / n FROM sums)"""
)
