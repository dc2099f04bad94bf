"""Idempotent table loads on parquet folders.

A table is a folder, partitioned by the columns its loads arrive in (``task_date``, ``econ`` ...), so a
load touches its own partitions only. All of them are bulk jobs: no row ever passes through the driver.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from firmlens.functions.columns import blank_to_null
from firmlens.session import stored

LEDGER = "_loads"  # beside a table: which run wrote which load in which batch


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Plain append; NaN is stored as NULL."""
    blank_to_null(df).write.mode("append").partitionBy(*partition_by).parquet(path)


def write_series(df: DataFrame, path: str, partition_by: list[str] = (), fmt: str = "csv") -> None:
    """Result series as CSV (with header) or parquet, one folder per partition value."""
    blank_to_null(df).write.mode("append").partitionBy(*partition_by).format(fmt).option("header", True).save(path)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the given order (reduced map-side by the window group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_", F.row_number().over(w)).where("row_ = 1").drop("row_")


def rows_to_insert(new: DataFrame, target: DataFrame | None, keys: list[str], order: list) -> DataFrame:
    """Insert-ignore: rows whose key the target lacks, of several with one key the first in ``order``."""
    single = first_per_key(new, keys, order)
    return single if target is None else single.join(target.select(*keys), keys, "left_anti")


def in_touched_partitions(target: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """The target's rows in partitions that ``new`` has rows for.

    The partition values of a load are folder names of the table, metadata like the listing that every read of it
    makes; they become a plain filter, which prunes folders at planning time. ``new`` is read for them alone, so pass a
    stored frame.
    """
    if not partition_by:
        return target
    return target.where(is_one_of(new.select(*partition_by).distinct().collect(), partition_by))


def is_one_of(values: list, columns: list[str]) -> Column:
    """Whether the columns hold one of these rows; NULL equals NULL."""
    hits = [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in values]
    return reduce(or_, hits, F.lit(False))


FILTER_VALUES = 16


def rows_of(df: DataFrame, values: list, columns: list[str], spark: SparkSession) -> DataFrame:
    """Rows of ``df`` whose columns hold one of ``values``.

    Few values are a filter. Many are a semi join, behind a plain list per column that prunes folders: a long chain of
    conditions would take longer to plan than to run.
    """
    if len(values) <= FILTER_VALUES:
        return df.where(is_one_of(values, columns))
    wanted = spark.createDataFrame(values, df.select(*columns).schema).select(*[F.col(c).alias(f"of_{c}") for c in columns])
    for c in columns:
        found = {row[c] for row in values}
        df = df.where(F.col(c).isin(*(found - {None})) | (F.col(c).isNull() if None in found else F.lit(False)))
    return df.join(wanted, reduce(and_, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in columns]), "left_semi")


def insert_ignore(df: DataFrame, path: str, keys: list[str], order: list, partition_by: list[str] = ()) -> None:
    """Append the rows whose key is not stored yet; the input is evaluated once."""
    target = read_if_exists(df.sparkSession, path)
    if target is not None and set(partition_by) <= set(keys):
        df = stored(df, "insert")
        target = in_touched_partitions(target, df, list(partition_by))
    append(rows_to_insert(df, target, keys, order), path, partition_by)


def upserted(new: DataFrame, target: DataFrame | None, keys: list[str], order: list) -> DataFrame:
    """Target rows with the new rows' values where keys meet, plus the new keys.

    Among several new rows of one key the last in ``order`` wins (the order is given as descending
    columns, so that the winner comes first). A new NULL overwrites too: presence, not value, decides.
    """
    latest = first_per_key(new, keys, order)
    if target is None:
        return latest
    values = [c for c in target.columns if c not in keys]
    n = latest.select(*keys, F.struct(*values).alias("new_"))
    o = target.select(*keys, F.struct(*values).alias("old_"))
    both = o.join(n, keys, "full_outer")
    picked = both.select(*keys, F.coalesce("new_", "old_").alias("v_"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"v_.{c}") for c in target.columns])


def upsert(
    df: DataFrame, path: str, keys: list[str], partition_by: list[str], order: list, hash_parts: int | None = None,
    newest: list[str] | None = None,
) -> None:
    """Upsert by key; only partitions that receive rows are rewritten.

    The partition columns must be part of the key (a row never moves between partitions), so reading the
    touched partitions is enough. A table without partition columns is laid out by a hash of its key
    (column ``part_``) in ``hash_parts`` folders: a number to choose once per table, by the size it is to reach, as a load
    rewrites the folders that its keys fall into. With ``newest``, stored rows compete in ``order`` with new ones. The input is evaluated once. The merged rows are first
    written to the shared scratch folder: the overwrite then reads nothing from the table it replaces, replaces
    partitions only when all of its tasks are done, and can simply be run again.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    spark = df.sparkSession
    layout = list(partition_by)
    df = blank_to_null(df)
    if not layout:
        if not hash_parts:
            raise ValueError("a table without partition columns needs hash_parts")
        layout = ["part_"]
        df = df.withColumn("part_", F.pmod(F.xxhash64(*keys), F.lit(hash_parts)).cast("int"))
        keys = [*keys, "part_"]
    target = read_if_exists(spark, path)
    if target is None:
        first_per_key(df, keys, order).write.partitionBy(*layout).parquet(path)
        return
    df = stored(df, "upsert-input")
    target = in_touched_partitions(target, df, layout)
    if newest:  # a stored row that is later than a new one keeps its place
        df = first_per_key(df.unionByName(target.select(*df.columns)), keys, order)
    merged = stored(upserted(df, target, keys, order), "upsert")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(path)


def rows_not_loaded(new: DataFrame, target: DataFrame | None, guard: list[str]) -> DataFrame:
    """Rows of loads (identified by the guard columns) the target holds no row of.

    The loads of ``new`` that are there already are a handful of values, so they become a filter: rows of a load, one
    key, are not joined. ``new`` is read twice; pass a stored frame.
    """
    if target is None:
        return new
    wanted = new.select(*guard).distinct()
    there = target.where(is_one_of(wanted.collect(), guard)).select(*guard).distinct().collect()
    return new.where(~is_one_of(there, guard))


def append_if_not_loaded(df: DataFrame, path: str, guard: list[str], partition_by: list[str]) -> None:
    """Append whole loads once; a repeated load adds nothing. A load must come in one piece; ``append_load`` takes parts."""
    target = read_if_exists(df.sparkSession, path)
    if target is not None:
        df = stored(df, "load")
        if set(partition_by) <= set(guard):
            target = in_touched_partitions(target, df, partition_by)
    append(rows_not_loaded(df, target, guard), path, partition_by)


def append_load(df: DataFrame, path: str, guard: list[str], partition_by: list[str], run: str, batch: int) -> None:
    """Append one batch of a run, whose loads may be spread over its batches and arrive late.

    A ledger beside the table holds a row per load, run and batch. Rows of loads that another run wrote are skipped; those of
    this run are appended, each batch in folders of its own (``run_``, ``batch_``), which a replay of the batch replaces. Rows come
    first and the ledger second, so a batch that broke off is simply replayed.
    """
    spark = df.sparkSession
    mark = {"run_": F.lit(hashlib.md5(run.encode()).hexdigest()), "batch_": F.lit(batch)}
    df = stored(blank_to_null(df), "batch")
    loads = df.select(*guard).distinct()
    ledger = read_if_exists(spark, path + LEDGER)
    if ledger is not None:
        others = ledger.where((F.col("run_") != mark["run_"]) & is_one_of(loads.collect(), guard))
        done = is_one_of(others.select(*guard).distinct().collect(), guard)
        df, loads = df.where(~done), loads.where(~done)
    for rows, where, layout in ((df, path, [*partition_by, *mark]), (loads, path + LEDGER, list(mark))):
        rows.withColumns(mark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(where)


def loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``append_load`` fills."""
    return spark.read.parquet(path).drop("run_", "batch_")


def with_new_names(names: DataFrame, dimension: DataFrame | None, id_col: str, name_col: str) -> DataFrame:
    """Dimension rows after get-or-create: unseen names get the next ids, in name order.

    The numbering window runs over distinct unseen names of a metadata dimension (metric names, model
    names, horizons), never over fact rows.
    """
    wanted = names.select(F.col(name_col)).where(F.col(name_col).isNotNull()).distinct()
    w = Window.orderBy(name_col)
    if dimension is None:
        return wanted.select(F.row_number().over(w).cast("long").alias(id_col), name_col)
    unseen = wanted.join(dimension.select(name_col), name_col, "left_anti")
    top = dimension.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("top_"))
    created = unseen.select(name_col, F.row_number().over(w).alias("n_")).select(
        (top.scalar() + F.col("n_")).cast("long").alias(id_col), name_col
    )
    return dimension.select(F.col(id_col).cast("long").alias(id_col), name_col).unionByName(created)


def get_or_create(names: DataFrame, path: str, id_col: str, name_col: str) -> DataFrame:
    """The ids of ``names`` in the dimension stored at ``path``; unseen names are inserted first and then read back."""
    spark = names.sparkSession
    there = read_if_exists(spark, path)
    every = with_new_names(names, there, id_col, name_col)
    insert_ignore(every, path, [name_col], [F.col(id_col).asc()])
    return spark.read.parquet(path).join(names.select(name_col).distinct(), name_col, "left_semi").select(id_col, name_col)


def groups_to_run(candidates: DataFrame, results: DataFrame | None, econ: str, horizon: int) -> DataFrame:
    """Candidates without a stored result for this horizon."""
    if results is None:
        return candidates
    done = results.where(F.col("horizon") == horizon).select(econ).distinct()
    return candidates.join(done, econ, "left_anti")
