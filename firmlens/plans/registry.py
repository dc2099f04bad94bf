"""Model registry: versioned model folders and one table of registered versions."""

from __future__ import annotations

from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.sources.sinks import append, read_if_exists

SCHEMA = "name string, version int, path string, train_date date, metrics map<string,double>"


def latest_versions(registry: DataFrame) -> DataFrame:
    """(name, version, path) of the newest version of each model."""
    return registry.groupBy("name").agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))


def _claimed(spark: SparkSession, path: str) -> bool:
    """Creates a file that must not exist yet; whether this call made it. Exactly one of several callers gets True."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    local = system.getScheme() == "file"
    try:
        system.mkdirs(file.getParent())
        if local:  # the local file system of the library looks before it creates; this call does both at once
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(file.toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            system.create(file, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next free version of ``name``, for this caller alone; one that is claimed and never recorded stays unused."""
    known = read_if_exists(spark, f"{root}/registry")
    last = None if known is None else known.where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    while not _claimed(spark, f"{root}/claims/{name}/{version}"):
        version += 1
    return version


def _record(row: DataFrame, place: str, table: str) -> None:
    """Adds a row to ``table``: written to ``place``, a folder of its own, and moved as a file.

    Appends to one folder share its temporary files, and the first writer that ends deletes those of the others.
    """
    append(row.coalesce(1), place)
    context = row.sparkSession.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    target = hadoop.Path(table)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for found in system.listStatus(hadoop.Path(place)):
        name = found.getPath().getName()
        if name.startswith("part-") and not system.rename(found.getPath(), hadoop.Path(target, name)):
            raise OSError(f"{found.getPath().toString()} was not moved to {table}")


def register_model(spark: SparkSession, root: str, name: str, model: PipelineModel, train_date: date,
                   metrics: dict[str, float | None]) -> int:
    """Claims the next version of ``name``, saves the model under it and records it; returns the version.

    Any number of writers may register at once: a version belongs to the one that created its claim.
    """
    table = f"{root}/registry"
    version = claim_version(spark, root, name)
    path = f"{root}/models/{name}/{version}"
    model.write().save(path)
    _record(spark.createDataFrame([(name, version, path, train_date, metrics)], SCHEMA), f"{root}/entries/{name}/{version}", table)
    return version


def load_latest(spark: SparkSession, root: str, name: str) -> PipelineModel:
    """The newest registered version of a model."""
    row = latest_versions(spark.read.parquet(f"{root}/registry").where(F.col("name") == name)).first()
    if row is None:
        raise LookupError(f"no version of model {name} is registered")
    return PipelineModel.load(row["path"])
