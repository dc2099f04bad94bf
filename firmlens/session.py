"""Session settings and the one place that decides where scratch tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "firmlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; further settings are passed by name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder, one per application: on a cluster the
    executors would each see a different one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """The frame written once as parquet below the shared folder and read back.

    For frames that several branches read: they are computed once, lineage is cut, readers keep column
    pruning, and a lost executor costs a re-read. The known schema spares the footer-inference job.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallel_parts(spark: SparkSession) -> int:
    """How many value ranges a large ordered group is cut into: a few per shuffle partition, for even tasks."""
    return max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
