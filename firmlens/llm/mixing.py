"""Mixing sources to target weights: hash-random order per source, prefix sums, cuts at exact budgets, epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.running import range_parts, running_starts
from firmlens.session import stored

WORD = r"[^\x20\x09-\x0D]+"


def _capped_targets(totals: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """``totals`` (source, source_size) with ``target``: shares by weight, none above ``max_epochs`` times its size.

    Resharing the excess until none is above ends at one level: sources with the smallest limit per unit of weight stop
    at their limit, all others get weight times level. Sorted by that ratio, the level follows from running sums. The
    table has one row per source, so these windows are as long as the list of sources.
    """
    everything = Window.partitionBy(F.lit(0))
    code_points = F.hex(F.encode("source", "UTF-8"))  # UTF-8 bytes sort as code points do
    place = F.row_number().over(everything.orderBy(F.col("source").isNull(), code_points)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    shares = totals.withColumn("weight", weight).withColumn("limit", (max_epochs * F.col("source_size")).cast("double"))
    rank = everything.orderBy(F.col("limit") / F.col("weight"), "source").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(rank), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rank), F.lit(0.0)),
    }).withColumn("level", F.col("left") / F.col("open"))
    # Levels rise as long as sources stop at their limit and fall afterwards; the highest is the one that holds.
    fits = F.when(F.col("limit") > F.col("weight") * F.col("level"), F.col("level"))
    shares = shares.withColumn("level", F.max(fits).over(everything))
    return shares.withColumn("target", F.least("limit", F.coalesce(F.col("weight") * F.col("level"), F.col("limit"))))


def order_in_source(id_col: str = "doc_id", seed: str = "mix") -> tuple[Column, Column]:
    """The order of a source's documents: a hash of the id, then the text's checksum."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))), F.crc32(text)


def mix(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix", keep: Sequence[str] = (), id_col: str = "doc_id",
    tie: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, ``source``, ``size`` (words), ``source_size``, ``target``, ``epochs``, ``part``, ``taken``.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share the sum of all sizes. A source takes each
    of its documents ``epochs`` times in full and ``part`` words of it once more: within the source, documents are in
    the order of a hash of their id and the running word count is cut at the budget, the rounded target. So every
    source takes exactly its budget, and ``taken = epochs * size + part`` is at most ``max_epochs`` sizes. The order is
    a function of id, text checksum and seed: reruns agree. A NULL text has size 0. ``keep`` names further columns of
    ``docs`` to carry along; those in ``tie`` order rows of one id and text. Texts are read once and not shuffled unless they
    are named there.
    """
    key, crc = order_in_source(id_col, seed)
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    slim = stored(docs.select(F.col(id_col), F.col("source"), words.alias("size"), key.alias("_key"), crc.alias("_crc"), *keep), "sizes")
    order = ["_key", "_crc", *tie]
    parted = range_parts(slim, ["source", *order])
    totals = stored(parted.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = stored(_capped_targets(totals, weights, max_epochs).select(F.col("source").alias("_source"), "source_size", "target"), "targets")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    placed = running_starts(parted, order, {"_start": "size"}, ["source"])
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("_start")
    placed = placed.withColumn("part", F.greatest(F.lit(0).cast("long"), F.least("size", rest)))
    return placed.select(id_col, "source", "size", "source_size", "target", "epochs", "part", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), *keep)
