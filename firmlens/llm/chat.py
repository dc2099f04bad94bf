"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

A turn is written as ``### role: text</turn>`` and a line break. Control strings inside roles and texts are broken up by a
backslash, reversibly. The context of an example is the formatted text of its conversation up to its reply, and only that reply
is trainable. Every example is written out in full, context and reply. The formatted turns are written once beside them.
The examples of a conversation share their prefixes: they are made from one copy of it for every ``CHUNK_TURNS`` turns, in tasks
that hold one such copy, and lie next to each other, so that compression finds the repeated text. A conversation of n turns gives
text in proportion to n * n all the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.running import range_parts, running_starts

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"
CHUNK_TURNS = 64  # turns of a conversation whose examples are made by one task, from one copy of the turns before them
# Values may be long: their sizes are looked at after every row, not after a hundred.
_LONG_VALUES = {"compression": "zstd", "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}
_HEADER = r"^### ([^:\\]*+(?:\\.[^:\\]*+)*+): "


@dataclass(frozen=True)
class ChatFiles:
    """Folders of the two tables: formatted turns, and examples with their texts."""

    turns: str
    examples: str


def escaped(text: Column) -> Column:
    """``text`` without ``##`` and ``</``: a backslash stands inside each of them and before each backslash.

    Neither the opening ``###`` nor the closing ``</turn>`` can occur in the result.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("##"), F.lit("#\\#")), F.lit("</"), F.lit("<\\/"))


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped`` (and of the colons escaped in roles)."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit(":"), F.lit("\\:")), F.lit(AFTER_ROLE))


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, ``position`` (from 0), ``start`` and ``end`` in its conversation's text, ``loss_start``,
    ``loss_end`` (code points, NULL for turns that are not trained) and ``formatted``.

    Turns go by ``turn``, NULL first; rows of one turn by role and checksum of the text, so repeated rows stay, side by side.
    NULL roles and texts are empty ones, a NULL ``conv_id`` is a conversation of its own; other columns are ignored.
    Positions and starts are prefix sums over range partitions: no task needs a whole conversation.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"), F.crc32(text.cast("binary")).alias("crc"))
    rows = rows.select(
        "conv_id", "turn", "role", "crc", F.concat(_header(F.col("role")), escaped(F.col("text")), F.lit(CLOSE)).alias("formatted"),
        F.length(_header(F.col("role"))).cast("long").alias("header"),
    ).withColumns({"chars": F.length("formatted").cast("long"), "one": F.lit(1)})
    order = ["turn", "role", "crc"]
    placed = running_starts(range_parts(rows, ["conv_id", *order]), order, {"position": "one", "start": "chars"}, ["conv_id"])
    end, trained = F.col("start") + F.col("chars"), F.col("role") == TRAINED_ROLE
    return placed.select(
        "conv_id", "position", "start", end.alias("end"), F.when(trained, F.col("start") + F.col("header")).alias("loss_start"),
        F.when(trained, end - len(CLOSE)).alias("loss_end"), "formatted",
    )


def expanded(turns: DataFrame) -> DataFrame:
    """The examples of formatted ``turns``: conv_id, position, text_chars, loss_start, loss_end and ``text`` in full."""
    part = F.expr(f"position DIV {CHUNK_TURNS}")
    # Conversations of several parts, by part, so that the turns of a long one meet their row in many tasks.
    ends = turns.groupBy(F.col("conv_id").alias("conv")).agg(F.max(part).alias("end_part")).where("end_part > 0")
    ends = ends.select("conv", "end_part", F.explode(F.sequence(F.lit(0).cast("long"), "end_part")).alias("at_part"))
    last = F.coalesce("end_part", "part")
    turn = F.struct("position", "formatted", "end", "loss_start", "loss_end")
    placed = turns.withColumn("part", part).join(ends, F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("at_part") == F.col("part")), "left")
    copies = placed.select("conv_id", F.explode(F.sequence("part", last)).alias("chunk"), last.alias("last"), turn.alias("turn"))
    whole = copies.groupBy("conv_id", "chunk", (F.col("chunk") == F.col("last")).alias("ends")).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    own = F.filter("turns", lambda t: (t["position"] >= F.col("chunk") * CHUNK_TURNS) & (t["loss_start"].isNotNull() | (F.col("ends") & (t["position"] == F.element_at("turns", -1)["position"]))))
    whole = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("all"), own.alias("own"))
    each = whole.select("conv_id", "all", F.explode(F.transform("own", lambda t: t.dropFields("formatted"))).alias("t"))
    return each.select("conv_id", "t.position", F.col("t.end").alias("text_chars"), "t.loss_start", "t.loss_end", F.expr("substring(all, 1, CAST(t.end AS int))").alias("text"))


def write_chat(conversations: DataFrame, path: str) -> ChatFiles:
    """Formats all conversations into Parquet tables below ``path``.

    ``turns``: conv_id, position, start, formatted. ``examples``: conv_id, ``position`` of the last turn, ``text`` (the
    formatted turns up to it, context and reply in full) and its length ``text_chars``, ``loss_start``, ``loss_end`` (code points of
    ``text`` under the loss mask). Turns behind the last reply (all turns, where there is none) make one example more, without a
    trainable part, so no turn is lost. An empty table gives two empty tables.
    """
    files, spark = ChatFiles(f"{path}/turns", f"{path}/examples"), conversations.sparkSession
    format_turns(conversations).write.parquet(f"{path}/formatted")
    turns = spark.read.parquet(f"{path}/formatted")
    turns.select("conv_id", "position", "start", "formatted").write.parquet(files.turns)
    expanded(turns).write.options(**_LONG_VALUES).parquet(files.examples)
    return files


def read_turns(spark: SparkSession, files: ChatFiles) -> DataFrame:
    """conv_id, position, start, formatted and the ``role`` and ``text`` parsed from it."""
    turns = spark.read.parquet(files.turns)
    role = F.regexp_extract("formatted", _HEADER, 1)
    body = F.expr(f"substring(formatted, {len(OPEN) + len(AFTER_ROLE) + 1} + length(raw_role), length(formatted) - length(raw_role) - {len(OPEN) + len(AFTER_ROLE) + len(CLOSE)})")
    return turns.withColumn("raw_role", role).select("conv_id", "position", "start", "formatted", unescaped(F.col("raw_role")).alias("role"), unescaped(body).alias("text"))


def read_targets(spark: SparkSession, files: ChatFiles) -> DataFrame:
    """conv_id, position and ``target`` (unescaped text under the loss mask) of every example that trains a reply."""
    examples = spark.read.parquet(files.examples).where("loss_start IS NOT NULL")
    masked = F.expr("substring(text, CAST(loss_start + 1 AS int), CAST(loss_end - loss_start AS int))")
    return examples.select("conv_id", "position", unescaped(masked).alias("target"))


def example_texts(spark: SparkSession, files: ChatFiles, examples: DataFrame) -> DataFrame:
    """``examples`` (rows of the examples table, read without their texts or with them) with ``text``, as a trainer reads them."""
    texts = spark.read.parquet(files.examples).select(F.col("conv_id").alias("conv"), F.col("position").alias("at"), "text")
    same = F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("at") == F.col("position"))
    return examples if "text" in examples.columns else examples.join(texts, same).drop("conv", "at")


def digests(spark: SparkSession, files: ChatFiles) -> DataFrame:
    """One row per conversation, read back from the files: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest of all texts of a conversation needs them in one value; only this check does, the tables do not.
    """
    def joined(column: str) -> Column:
        return F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("position", column))), lambda p: p[column]))

    turns = read_turns(spark, files).withColumn("line", F.concat("role", F.lit("\n"), "text", F.lit("\n")))
    turns = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sha2(joined("line"), 256).alias("turns_sha256"))
    losses = read_targets(spark, files).groupBy(F.col("conv_id").alias("conv")).agg(F.sum(F.length("target").cast("long")).alias("loss"), joined("target").alias("target"))
    sizes = spark.read.parquet(files.examples).groupBy(F.col("conv_id").alias("key")).agg(F.sum(F.length("text").cast("long")).alias("formatted_chars"))
    out = turns.join(sizes, F.col("key").eqNullSafe(F.col("conv_id"))).join(losses, F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    return out.select(
        "conv_id", "n_turns", "turns_sha256", F.coalesce("loss", F.lit(0).cast("long")).alias("loss_chars"),
        F.sha2(F.coalesce("target", F.lit("")), 256).alias("loss_sha256"), "formatted_chars",
    )
