"""Contiguous shards of nearly equal bytes, cut from global prefix sums of document sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.running import range_parts, running_starts
from firmlens.session import stored


def byte_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with ``size`` (UTF-8 bytes + 1, a NULL text has none), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Rows are ordered by id (NULL first; equal ids by size and checksum). Texts stay where they are: only (id, size,
    checksum) is range-partitioned. Totals per partition are cumulated to global positions, and a row belongs to the
    shard in whose byte range its middle lies, so a shard misses its equal target by at most one row at each end.
    ``slot`` counts rows of a shard from 0. The law is ``bytes``; ``grown_shard`` is NULL under it. Shards can be empty
    where one row is larger than a target. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(1).alias("_one"))
    order = ["_id", "size", "text_crc32"]
    parted = range_parts(slim, order)
    placed = running_starts(parted, order, {"_start": "size", "_index": "_one"})
    total = parted.agg(F.coalesce(F.sum("size"), F.lit(1)).alias("t")).first()["t"]
    middle = f"cast(2 * _start + size AS decimal(28,0)) * {shards} div cast({2 * total} AS decimal(28,0))"
    shard = F.least(F.lit(shards - 1), F.expr(middle).cast("int"))
    placed = stored(placed.select("_id", "size", "text_crc32", "_index", shard.alias("shard")), "placed")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("_index").alias("_first")))  # one row per shard
    return placed.join(first, "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_index") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
