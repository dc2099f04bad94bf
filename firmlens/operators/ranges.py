"""Exact running totals over ordered groups of any size.

A window ordered over a whole group runs in one task per group. Here a group is cut into value ranges: the
ranges are cumulated among themselves first (one row per group and range), then inside each range. The cut
points are quantiles of all values together, so no (group, range) holds more than about 1/parts of the
distinct values, whatever the groups look like. They are taken once, as at most ``parts - 1`` numbers, so
every stage and every re-run of a lost task sees the same ranges; where exactly they fall has no influence
on results.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.session import parallel_parts, stored

BUCKET = "bucket_"


def quantile_cuts(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """At most ``parts - 1`` distinct cut points of a numeric column (a fixed-size sketch per task)."""
    parts = parts or parallel_parts(df.sparkSession)
    if parts < 2:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    found = df.select(F.col(column).cast("double").alias(column)).approxQuantile(column, probabilities, 1 / (4 * parts))
    return sorted(set(found))


def with_bucket(df: DataFrame, column: str, cuts: list[float]) -> DataFrame:
    """Adds the range number of a value: 0 below the first cut, i from the i-th cut on."""
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    numbered = df.withColumn("cut_value_", F.col(column).cast("double"))
    out = Bucketizer(splits=splits, inputCol="cut_value_", outputCol=BUCKET, handleInvalid="keep").transform(numbered)
    return out.drop("cut_value_").withColumn(BUCKET, F.col(BUCKET).cast("int"))


def range_totals(cells: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Totals per (keys, range) of cells that carry their range number."""
    return cells.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(c) for c in sums])


def range_starts(totals: DataFrame, keys: list[str], sums: list[str], descending: bool = False) -> DataFrame:
    """One start row per (keys, range): its sums are the totals of all earlier ranges, ``all_<c>`` those of the group."""
    first = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    earlier = Window.partitionBy(*keys).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    return totals.select(
        *keys, BUCKET,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("long").alias(c) for c in sums],
        *[F.sum(c).over(group).cast("long").alias(f"all_{c}") for c in sums],
    )


def stack_with_starts(cells: DataFrame, starts: DataFrame, order: str, sums: list[str]) -> DataFrame:
    """Cells (``kind_`` 1) and start rows (``kind_`` 0) in one frame; a start row has no value of its own."""
    marked = cells.withColumns({**{c: F.col(c).cast("long") for c in sums}, "kind_": F.lit(1)})
    return marked.unionByName(starts.withColumn("kind_", F.lit(0)), allowMissingColumns=True)


def cumulate(stacked: DataFrame, keys: list[str], order: str, sums: list[str], descending: bool = False) -> DataFrame:
    """Adds ``before_<c>`` and ``all_<c>`` to the cells of a stacked frame.

    Within its (keys, range) the start row comes first and opens every running total, so range totals reach
    the cells without a join.
    """
    value = F.col(order).desc() if descending else F.col(order).asc()
    so_far = Window.partitionBy(*keys, BUCKET).orderBy("kind_", value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked.withColumns({
        **{f"before_{c}": F.sum(c).over(so_far) - F.col(c) for c in sums},
        **{f"all_{c}": F.first(f"all_{c}").over(so_far) for c in sums},
    })
    return out.where("kind_ = 1").drop("kind_", BUCKET)


def running_totals(
    cells: DataFrame, keys: list[str], order: str, sums: list[str], descending: bool = False,
) -> DataFrame:
    """Adds ``before_<c>`` (total of the rows that come earlier) and ``all_<c>`` (group total) for each sum.

    ``cells`` hold the keys, the range number (``with_bucket``), the ordering value and the sums. They are
    shuffled once, by (keys, range).
    """
    starts = range_starts(range_totals(cells, keys, sums), keys, sums, descending)
    return cumulate(stack_with_starts(cells, starts, order, sums), keys, order, sums, descending)


def with_next(cells: DataFrame, keys: list[str], order: str, values: list[str], descending: bool = False) -> DataFrame:
    """Adds ``next_<c>``, the value of the group's next cell in ``order``; NULL for its last one.

    Inside a (keys, range) it is a lead. Over the border of a range the first cell of the next range that has any is handed back as a
    closing row: one row per group and range travels, and no group is ordered in one task. ``cells`` hold one row per (keys,
    order) and their range number.
    """
    head = (F.max_by if descending else F.min_by)(F.struct(*values), order)
    along = Window.partitionBy(*keys).orderBy(F.col(BUCKET).desc() if descending else F.col(BUCKET).asc())
    heads = cells.groupBy(*keys, BUCKET).agg(head.alias("head_"))
    closing = heads.withColumn("head_", F.lead("head_").over(along)).where("head_ IS NOT NULL").select(*keys, BUCKET, "head_.*", F.lit(1).alias("closing_"))
    both = cells.withColumn("closing_", F.lit(0)).unionByName(closing, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, BUCKET).orderBy("closing_", F.col(order).desc() if descending else F.col(order).asc())
    out = both.withColumns({f"next_{c}": F.lead(c).over(inside) for c in values})
    return out.where("closing_ = 0").drop("closing_")


def exact_quantiles(df: DataFrame, keys: list[str], column: str, probabilities: dict[str, float],
                    cuts: list[float] | None = None, distinct: str | None = None) -> DataFrame:
    """Exact interpolated quantiles per group, one column per name, by counting instead of collecting values.

    ``distinct`` names an extra column for the number of distinct values, which the counts give for free.
    """
    present = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    cells = present.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    if cuts is None:
        cells = stored(cells, "value_counts")
        cuts = quantile_cuts(cells, column)
    cells = with_bucket(cells, column, cuts)
    placed = running_totals(cells, keys, column, ["n"])

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("before_n") <= position) & (position < F.col("before_n") + F.col("n")), F.col(column)))

    aggs = []
    for name, q in probabilities.items():
        place = (F.col("all_n") - 1) * q
        aggs += [at(F.floor(place)).alias(f"lo_{name}"), at(F.ceil(place)).alias(f"hi_{name}"), F.max(place - F.floor(place)).alias(f"part_{name}")]
    found = placed.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).cast("double").alias("cells_"))
    return found.select(
        *keys,
        *([F.col("cells_").alias(distinct)] if distinct else []),
        *[(F.col(f"lo_{n}") + (F.col(f"hi_{n}") - F.col(f"lo_{n}")) * F.col(f"part_{n}")).alias(n) for n in probabilities],
    )
