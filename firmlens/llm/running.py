"""Running totals over an order of any length: range partitions, totals per partition, sums inside partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.session import stored


def range_parts(df: DataFrame, order: Sequence[str], parts: int | None = None, descending: bool = False) -> DataFrame:
    """The rows range-partitioned by ``order`` and written once, with columns ``_row`` and ``_part``.

    ``_row`` breaks ties, so equal rows can be dealt over several partitions. The table is written because partition
    numbers must stay the same for all that reads them, also after a lost executor.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [F.col(c).desc() if descending else F.col(c) for c in [*order, "_row"]]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    return stored(ranged.withColumn("_part", F.spark_partition_id()), "ranged")


def running_starts(parted: DataFrame, order: Sequence[str], values: dict[str, str], group: Sequence[str] = ()) -> DataFrame:
    """Adds, for each ``name: column`` of ``values``, the sum of ``column`` over all earlier rows of the row's group.

    ``parted`` comes from ``range_parts`` by ``group`` + ``order`` (or has a ``_part`` and a ``_row`` of its own where the
    order across partitions is free). Partition totals are cumulated among themselves, one row per (group, partition),
    and enter each partition as a first row that carries the sum before it: no join, and no task holds more than one
    partition of one group. Columns of ``values`` must not be NULL.
    """
    group = list(group)
    totals = parted.groupBy("_part", *group).agg(*[F.sum(c).cast("long").alias(n) for n, c in values.items()])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *group, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_add_{n}") for n in values])
    rows = parted.withColumns({"_is_row": F.lit(1), **{f"_add_{n}": F.col(c).cast("long") for n, c in values.items()}})
    both = rows.unionByName(offsets.withColumn("_is_row", F.lit(0)), allowMissingColumns=True)
    within = Window.partitionBy("_part", *group).orderBy("_is_row", *order, "_row").rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({n: F.sum(f"_add_{n}").over(within) for n in values})
    return out.where("_is_row = 1").select(*parted.columns, *values)
