"""Readers for panels, covariate cubes, event histories, term structures and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firmlens.functions.columns import blank_to_null
from firmlens.functions.constants import CUBE_COLUMNS, HORIZONS

TERM_KEYS = ["comp_id", "yy", "mm", "dd"]


def read_panel_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Headered CSV with a declared schema: one pass, no inference scan; NaN and blanks become NULL."""
    return blank_to_null(spark.read.schema(schema).option("header", True).csv(path))


def file_name_part(position: int) -> Column:
    """The ``_``-separated part of the source file's name at a 0-based position, NULL when there is none."""
    return F.try_element_at(F.split(F.col("_metadata.file_name"), "_"), F.lit(position + 1))


def file_name_suffix() -> Column:
    """Text between the last ``_`` and the file extension."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"_([^_.]+)\.[^.]*$", 1)


def read_economy_files(
    spark: SparkSession, pattern: str, schema: StructType | str, position: int | None = 2
) -> DataFrame:
    """All economies' files as ONE frame, the economy taken from the file name.

    ``position`` counts the ``_``-separated part; ``None`` takes the last part before the extension.
    Files without that part are left out.
    """
    raw = spark.read.schema(schema).option("header", True).csv(pattern)
    econ = file_name_suffix() if position is None else file_name_part(position)
    named = raw.select("*", econ.alias("econ"))
    return blank_to_null(named.where(F.col("econ").isNotNull() & (F.col("econ") != "")))


def explode_cube(df: DataFrame, cube: str, names: list[str] = CUBE_COLUMNS, keep: list[str] = ()) -> DataFrame:
    """firm x variable x month cube -> one row per (firm, month) with one column per variable.

    The cube is an array (firm) of arrays (variable) of arrays (month); the variables of one firm are
    zipped by month, so each output row is built from its own firm only.
    """
    firms = df.select(*keep, F.posexplode(cube).alias("firm_pos", "by_variable"))
    months = firms.select(
        *keep,
        "firm_pos",
        F.posexplode(F.arrays_zip(*[F.col("by_variable")[i].alias(n) for i, n in enumerate(names)])).alias(
            "month_pos", "v"
        ),
    )
    return months.select(*keep, "firm_pos", "month_pos", *[F.col("v")[n].alias(n) for n in names])


def firm_history(df: DataFrame, raw_id: str, day: str, event: str) -> DataFrame:
    """(comp_id, yyyymmdd, event_type): the id loses its 3-digit suffix, a missing event is 0."""
    return df.select(
        F.floor(F.col(raw_id) / 1000).cast("long").alias("comp_id"),
        F.col(day).cast("int").alias("yyyymmdd"),
        F.coalesce(F.when(~F.isnan(F.col(event).cast("double")), F.col(event)), F.lit(0)).cast("int").alias("event_type"),
    )


def term_structures(pd_rows: DataFrame, poe_rows: DataFrame) -> DataFrame:
    """Default and exit term structures side by side, for the firm-days that both have."""
    pd_cols = [f"pd_{h}" for h in HORIZONS]
    poe_cols = [f"poe_{h}" for h in HORIZONS]
    return pd_rows.select(*TERM_KEYS, *pd_cols).join(poe_rows.select(*TERM_KEYS, *poe_cols), TERM_KEYS, "inner")


def read_table(spark: SparkSession, name: str, root: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A stored table: a parquet folder below ``root`` or a catalog table; columns are pruned in the scan."""
    df = spark.read.parquet(f"{root}/{name}") if root else spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A database table read in ``parts`` key ranges, so that no single task pulls the whole table."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in options.items():
        reader = reader.option(name, value)
    return (
        reader.option("partitionColumn", key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .load()
    )
