"""Sources and sinks (S1-S8, K1-K9)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.catalog.registry import query
from firmlens.functions.constants import CUBE_COLUMNS, HORIZONS
from firmlens.operators.prep import stamped
from firmlens.session import scratch_path
from firmlens.sources import readers, roles, sinks

PANEL_COLUMNS = ["econ", "firm", "ym", "year", "month", "sizelevel", "sizetrend", "m2b", "sigma", "liqfinlevel",
                 "DTDmedianNonFin", "Y"]
PANEL_OUT = "econ:i firm:i ym:d year:i month:i sizelevel:r sizetrend:r m2b:r sigma:r liqfinlevel:r DTDmedianNonFin:r Y:i"
PANEL_SCHEMA = (
    "econ int, firm long, ym date, year int, month int, sizelevel double, sizetrend double, m2b double, sigma double, "
    "liqfinlevel double, DTDmedianNonFin double, Y int"
)
_PANEL_TEXT = f"WITH {roles.PANEL_SQL} SELECT {', '.join(PANEL_COLUMNS)} FROM panel"


@query("src_csv_panel", PANEL_OUT, _PANEL_TEXT)
def src_csv_panel(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "panel_csv")
    roles.panel(spark, folder).select(*PANEL_COLUMNS).write.option("header", True).csv(path)
    return readers.read_panel_csv(spark, path, PANEL_SCHEMA)


def _economy_files(spark: SparkSession, folder: str, prefix: str, suffix: str) -> str:
    """Writes one set of CSV files per economy and gives them names that carry the economy; returns a glob.

    Spark names its part files itself, so they are renamed afterwards (file system metadata only).
    """
    path = scratch_path(spark, "economies")
    df = roles.panel(spark, folder).select(*PANEL_COLUMNS)
    df.withColumn("code", F.col("econ")).write.partitionBy("code").option("header", True).csv(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(hadoop.Path(f"{path}/code=*/part-*.csv")):
        part = status.getPath()
        code = part.getParent().getName().split("=")[1]
        number = part.getName().split("-")[1]
        fs.mkdirs(hadoop.Path(f"{path}/named/{number}"))
        fs.rename(part, hadoop.Path(f"{path}/named/{number}/{prefix}_{code}{suffix}.csv"))
    return f"{path}/named/*/*.csv"


@query("src_glob_econ", PANEL_OUT + " file_econ:i",
       f"WITH {roles.PANEL_SQL} SELECT {', '.join(PANEL_COLUMNS)}, econ AS file_econ FROM panel")
def src_glob_econ(spark: SparkSession, folder: str) -> DataFrame:
    pattern = _economy_files(spark, folder, "merged_output", "_202508")
    df = readers.read_economy_files(spark, pattern, PANEL_SCHEMA.replace("econ int", "code int"))
    return df.select("*", F.col("econ").alias("file_econ"))


@query("src_suffix_key", "company:i n_rows:i cents:r",
       f"WITH {roles.PANEL_SQL} SELECT econ AS company, count(*) AS n_rows, sum(sizelevel) AS cents FROM panel GROUP BY econ")
def src_suffix_key(spark: SparkSession, folder: str) -> DataFrame:
    pattern = _economy_files(spark, folder, "outcomes_of", "")
    df = readers.read_economy_files(spark, pattern, PANEL_SCHEMA.replace("econ int", "code int"), position=None)
    return df.groupBy(F.col("econ").alias("company")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sizelevel").alias("cents"))


_CUBE_SQL = """
WITH halves AS (
  SELECT vec_id, 0 AS firm_pos, embedding AS e FROM embeddings
  UNION ALL SELECT vec_id, 1, list_reverse(embedding) FROM embeddings),
months AS (SELECT unnest([0, 1, 2]) AS month_pos)
SELECT vec_id, firm_pos, month_pos, """ + ", ".join(
    f"CAST(e[{3 * i + 1} + month_pos] AS DOUBLE) AS {n}" for i, n in enumerate(CUBE_COLUMNS)
) + " FROM halves, months"


@query("src_explode_cube", "vec_id:i firm_pos:i month_pos:i " + " ".join(f"{c}:r" for c in CUBE_COLUMNS), _CUBE_SQL)
def src_explode_cube(spark: SparkSession, folder: str) -> DataFrame:
    vectors = roles.table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    by_variable = lambda e: F.array(*[F.slice(e, 3 * i + 1, 3) for i in range(len(CUBE_COLUMNS))])
    cubes = vectors.select("vec_id", F.array(by_variable(F.col("e")), by_variable(F.reverse("e"))).alias("firmspecific"))
    return readers.explode_cube(cubes, "firmspecific", keep=["vec_id"])


_HISTORY_SQL = """
SELECT CAST(floor((user_id * 1000 + event_id % 1000) / 1000) AS BIGINT) AS comp_id,
  CAST(strftime(ts, '%Y%m%d') AS INT) AS yyyymmdd,
  CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS event_type FROM events"""


@query("src_firm_history", "comp_id:i yyyymmdd:i event_type:i", _HISTORY_SQL)
def src_firm_history(spark: SparkSession, folder: str) -> DataFrame:
    code = F.when(F.col("event_type") == "error", 1.0).when(F.col("event_type") == "signup", 2.0)
    raw = roles.table(spark, folder, "events").select(
        (F.col("user_id") * 1000 + F.col("event_id") % 1000).alias("raw"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("day"),
        code.alias("event"),
    )
    return readers.firm_history(raw, "raw", "day", "event")


_TERM_COLUMNS = [f"pd_{h}" for h in HORIZONS] + [f"poe_{h}" for h in HORIZONS]


@query("src_term_structure", "comp_id:i yy:i mm:i dd:i " + " ".join(f"{c}:r" for c in _TERM_COLUMNS),
       f"WITH {roles.STAT_SQL} SELECT * EXCLUDE (task_date) FROM stat_pd JOIN stat_poe USING (comp_id, yy, mm, dd)")
def src_term_structure(spark: SparkSession, folder: str) -> DataFrame:
    return readers.term_structures(roles.stat_pd(spark, folder), roles.stat_poe(spark, folder))


def metadata_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The metadata star: one model per (economy, year), two metrics per model, dimensions next to them."""
    nation = roles.table(spark, folder, "nation")
    per_model = roles.panel(spark, folder).groupBy("econ", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("Y") == 1).alias("n1")
    ).withColumn("model_id", F.col("econ") * 100 + F.col("year") - 1995)
    names = lambda pairs, id_col, name_col: nation.limit(1).select(
        F.explode(F.array(*[F.struct(F.lit(i).alias(id_col), F.lit(n).alias(name_col)) for i, n in pairs])).alias("s")
    ).select("s.*")
    return {
        "econ": nation.select(F.col("n_nationkey").alias("econ_id"), F.col("n_name").alias("econ_name")),
        "company": roles.table(spark, folder, "customer").select(F.col("c_custkey").alias("comp_id"), F.col("c_name").alias("company_name")),
        "metrics_type": names([(1, "default_rate"), (2, "n_rows")], "metrics_type_id", "metrics_name"),
        "model_type": names([(1, "boosted"), (2, "linear")], "model_type_id", "model_name"),
        "metric": names([(1, "auc"), (2, "ar")], "metric_id", "metric_name"),
        "target": names([(1, "pd_poe_1"), (2, "pd_poe_12")], "target_id", "target_name"),
        "model": per_model.select("model_id", (F.col("year") % 2 + 1).alias("model_type_id"), (F.col("year") - 1994).alias("version"),
                                  F.col("econ").alias("econ_id"), F.lit(1).alias("target_id")),
        "metrics": per_model.select(
            "model_id",
            F.explode(F.array(
                F.struct(F.lit(1).alias("metrics_type_id"), (F.col("n1") / F.col("n")).alias("value")),
                F.struct(F.lit(2).alias("metrics_type_id"), F.col("n").cast("double").alias("value")),
            )).alias("m"),
        ).select("m.metrics_type_id", "model_id", "m.value"),
    }


STAR_SQL = roles.PANEL_SQL + """,
per_model AS (SELECT econ, year, count(*) AS n, sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) AS n1,
    econ * 100 + year - 1995 AS model_id FROM panel GROUP BY econ, year),
econ AS (SELECT n_nationkey AS econ_id, n_name AS econ_name FROM nation),
metrics_type AS (SELECT 1 AS metrics_type_id, 'default_rate' AS metrics_name UNION ALL SELECT 2, 'n_rows'),
model AS (SELECT model_id, econ AS econ_id FROM per_model),
metrics AS (SELECT 1 AS metrics_type_id, model_id, n1 / n AS value FROM per_model
  UNION ALL SELECT 2, model_id, CAST(n AS DOUBLE) FROM per_model)"""


@query("src_dimension_tables", "table_name id:i name", """
SELECT 'econ' AS table_name, n_nationkey AS id, n_name AS name FROM nation
UNION ALL SELECT 'company', c_custkey, c_name FROM customer
UNION ALL SELECT 'metrics_type', row_number() OVER (ORDER BY name), name FROM (SELECT DISTINCT event_type AS name FROM events)
UNION ALL SELECT 'metric', row_number() OVER (ORDER BY name), name FROM (SELECT DISTINCT o_orderpriority AS name FROM orders)
UNION ALL SELECT 'model_type', row_number() OVER (ORDER BY name), name FROM (SELECT DISTINCT c_mktsegment AS name FROM customer)
UNION ALL SELECT 'target', row_number() OVER (ORDER BY name), name FROM (SELECT DISTINCT o_orderstatus AS name FROM orders)""")
def src_dimension_tables(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "star")
    star = metadata_star(spark, folder)
    # Code lists of the tables stand in for the lists of metrics, models and targets.
    lists = {"metrics_type": ("events", "event_type"), "metric": ("orders", "o_orderpriority"), "model_type": ("customer", "c_mktsegment"), "target": ("orders", "o_orderstatus")}
    for name, (source, column) in lists.items():
        star[name] = sinks.with_new_names(roles.table(spark, folder, source), None, f"{name}_id", column)
    out = None
    for name in ("econ", "metric", "company", "metrics_type", "model_type", "target"):
        star[name].write.parquet(f"{root}/{name}")
        df = readers.read_table(spark, name, root)
        rows = df.select(F.lit(name).alias("table_name"), F.col(df.columns[0]).cast("long").alias("id"), F.col(df.columns[1]).alias("name"))
        out = rows if out is None else out.unionByName(rows)
    return out


_STORED_SQL = f"""WITH {roles.PREDICTIONS_SQL}
SELECT 'stats' AS table_name, comp_id, yyyymmdd, pd_1, poe_1, NULL AS event_type, task_date FROM stats
UNION ALL SELECT 'model', comp_id, yyyymmdd, pd_1, poe_1, NULL, task_date FROM model
UNION ALL SELECT 'truth', comp_id, yyyymmdd, NULL, NULL, event_type, task_date FROM truth"""


@query("src_prediction_tables", "table_name comp_id:i yyyymmdd:d pd_1:r poe_1:r event_type:f task_date:d", _STORED_SQL)
def src_prediction_tables(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "predictions")
    roles.stat_predictions(spark, folder).write.partitionBy("task_date").parquet(f"{root}/stats")
    roles.model_predictions(spark, folder).write.partitionBy("task_date").parquet(f"{root}/model")
    roles.ground_truth(spark, folder).write.partitionBy("task_date").parquet(f"{root}/truth")
    keys = ["comp_id", "yyyymmdd", "task_date"]
    stats = readers.read_table(spark, "stats", root, [*keys, "pd_1", "poe_1"])
    model = readers.read_table(spark, "model", root, [*keys, "pd_1", "poe_1"])
    truth = readers.read_table(spark, "truth", root, [*keys, "event_type"])
    tagged = lambda df, name: df.withColumn("table_name", F.lit(name))
    return (
        tagged(stats, "stats")
        .unionByName(tagged(model, "model"))
        .unionByName(tagged(truth, "truth"), allowMissingColumns=True)
        .orderBy("table_name", "comp_id", "yyyymmdd")
    )


def _class_series(spark: SparkSession, folder: str) -> DataFrame:
    counts = roles.panel(spark, folder).groupBy("econ", "ym").agg(
        F.count(F.lit(1)).alias("test_size"), F.count_if(F.col("Y") == 1).alias("test_positives")
    )
    return stamped(counts, horizon=12)


_SERIES_TEXT = f"""WITH {roles.PANEL_SQL}, series AS (
  SELECT econ, ym, count(*) AS test_size, sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) AS test_positives FROM panel GROUP BY econ, ym)
SELECT econ, 12 AS horizon, ym, test_size, test_positives FROM series"""


@query("sink_metrics_csv", "econ:i horizon:i ym:d test_size:i test_positives:i", _SERIES_TEXT)
def sink_metrics_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "series")
    sinks.write_series(_class_series(spark, folder), path, ["econ", "horizon"])
    schema = "ym date, test_size long, test_positives long, econ int, horizon int"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("sink_append", "econ:i horizon:i ym:d test_size:i test_positives:i",
       _SERIES_TEXT + " UNION ALL SELECT econ, 1, ym, test_size, test_positives FROM series")
def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "append")
    sinks.append(_class_series(spark, folder), path, ["econ"])
    sinks.append(stamped(_class_series(spark, folder), horizon=1), path, ["econ"])
    return spark.read.parquet(path)


CUT_DAY = date(2024, 1, 16)


@query("sink_insert_ignore", "comp_id:i yyyymmdd:d pd_1:r load:i", f"""WITH {roles.PREDICTIONS_SQL}
SELECT comp_id, yyyymmdd, pd_1, CASE WHEN yyyymmdd < DATE '2024-01-16' THEN 1 ELSE 2 END AS load FROM model""")
def sink_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "insert_ignore")
    rows = roles.model_predictions(spark, folder).select("comp_id", "yyyymmdd", "pd_1")
    order = [F.col("pd_1").asc()]
    sinks.insert_ignore(stamped(rows.where(F.col("yyyymmdd") < CUT_DAY), load=1), path, ["comp_id", "yyyymmdd"], order, ["yyyymmdd"])
    sinks.insert_ignore(stamped(rows, load=2), path, ["comp_id", "yyyymmdd"], order, ["yyyymmdd"])
    return spark.read.parquet(path)


@query("sink_upsert_predictions", "comp_no:i yyyymmdd:d model_id:i target_id:i econ_id:i value:r operation_date:d", f"""
WITH {roles.PREDICTIONS_SQL},
fresh AS (SELECT * FROM stats WHERE yyyymmdd >= DATE '2024-01-16')
SELECT coalesce(f.comp_id, m.comp_id) AS comp_no, coalesce(f.yyyymmdd, m.yyyymmdd) AS yyyymmdd, 1 AS model_id, 1 AS target_id,
  coalesce(f.comp_id, m.comp_id) % 25 AS econ_id, CASE WHEN f.comp_id IS NULL THEN m.pd_1 ELSE f.pd_1 END AS value,
  CASE WHEN f.comp_id IS NULL THEN DATE '2024-02-01' ELSE DATE '2024-02-02' END AS operation_date
FROM model m FULL JOIN fresh f ON m.comp_id = f.comp_id AND m.yyyymmdd = f.yyyymmdd""")
def sink_upsert_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "upsert_predictions")
    keys = ["comp_no", "yyyymmdd", "model_id", "target_id", "econ_id"]

    def rows(df: DataFrame, day: date) -> DataFrame:
        return stamped(
            df.select(F.col("comp_id").alias("comp_no"), "yyyymmdd", (F.col("comp_id") % 25).cast("int").alias("econ_id"), F.col("pd_1").alias("value")),
            model_id=1, target_id=1, operation_date=day,
        )

    order = [F.col("operation_date").desc(), F.col("value").desc()]
    sinks.upsert(rows(roles.model_predictions(spark, folder), date(2024, 2, 1)), path, keys, ["yyyymmdd"], order)
    fresh = roles.stat_predictions(spark, folder).where(F.col("yyyymmdd") >= CUT_DAY)
    sinks.upsert(rows(fresh, date(2024, 2, 2)), path, keys, ["yyyymmdd"], order)
    return spark.read.parquet(path)


@query("sink_upsert_metric", "metrics_type_id:i model_id:i value:r", f"""
WITH {STAR_SQL} SELECT metrics_type_id, model_id, CASE WHEN metrics_type_id = 1 THEN value ELSE value + 0.5 END AS value FROM metrics""")
def sink_upsert_metric(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "upsert_metric")
    metrics = metadata_star(spark, folder)["metrics"]
    keys, order = ["metrics_type_id", "model_id"], [F.col("value").desc()]
    sinks.upsert(metrics, path, keys, [], order, hash_parts=16)
    revised = metrics.where("metrics_type_id = 2").withColumn("value", F.col("value") + 0.5)
    sinks.upsert(revised, path, keys, [], order, hash_parts=16)
    return spark.read.parquet(path)


@query("sink_get_or_create_dim", "id:i name", """
WITH first AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT event_type AS name FROM events)),
wanted AS (SELECT DISTINCT o_orderpriority AS name FROM orders UNION SELECT name FROM first),
unseen AS (SELECT name FROM wanted WHERE name NOT IN (SELECT name FROM first))
SELECT id, name FROM first
UNION ALL SELECT (SELECT max(id) FROM first) + row_number() OVER (ORDER BY name), name FROM unseen""")
def sink_get_or_create_dim(spark: SparkSession, folder: str) -> DataFrame:
    kinds = roles.table(spark, folder, "events").select(F.col("event_type").alias("name"))
    more = roles.table(spark, folder, "orders").select(F.col("o_orderpriority").alias("name"))
    path = scratch_path(spark, "dimension")
    sinks.get_or_create(kinds, path, "id", "name")
    return sinks.get_or_create(more.union(kinds), path, "id", "name")


@query("sink_skip_if_loaded", "comp_id:i yyyymmdd:d task_date:d econ:i pd_1:r load:i", f"""WITH {roles.PREDICTIONS_SQL}
SELECT comp_id, yyyymmdd, task_date, econ, pd_1, CASE WHEN econ < 10 THEN 1 ELSE 2 END AS load FROM model""")
def sink_skip_if_loaded(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "skip_if_loaded")
    rows = roles.model_predictions(spark, folder).select("comp_id", "yyyymmdd", "task_date", "econ", "pd_1")
    guard = ["task_date", "econ"]
    sinks.append_if_not_loaded(stamped(rows.where("econ < 10"), load=1), path, guard, ["task_date"])
    sinks.append_if_not_loaded(stamped(rows, load=2), path, guard, ["task_date"])
    sinks.append_if_not_loaded(stamped(rows, load=3), path, guard, ["task_date"])
    return spark.read.parquet(path)


@query("sink_nan_to_null", "comp_id:i day:d mean_view:r", f"""WITH {roles.FIRM_DAYS_SQL}
SELECT comp_id, day, CASE WHEN n_view > 0 THEN c_view / n_view END AS mean_view FROM firm_days""")
def sink_nan_to_null(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "nan_to_null")
    days = roles.firm_days(spark, folder)
    mean = F.when(F.col("n_view") > 0, F.col("c_view") / F.col("n_view")).otherwise(F.lit(float("nan")))
    sinks.append(days.select("comp_id", "day", mean.alias("mean_view")), path, ["day"])
    return spark.read.parquet(path)


@query("chk_already_done", "econ_id:i econ_name", f"""WITH {roles.PANEL_SQL}
SELECT n_nationkey AS econ_id, n_name AS econ_name FROM nation
WHERE n_nationkey NOT IN (SELECT econ FROM panel GROUP BY econ HAVING sum(CASE WHEN Y = 1 THEN 1 ELSE 0 END) % 2 = 0)""")
def chk_already_done(spark: SparkSession, folder: str) -> DataFrame:
    defaults = roles.panel(spark, folder).groupBy("econ").agg(F.count_if(F.col("Y") == 1).alias("n"))
    results = stamped(defaults.where("n % 2 = 0").select(F.col("econ").alias("econ_id")), horizon=12)
    return sinks.groups_to_run(metadata_star(spark, folder)["econ"], results, "econ_id", 12)
