"""From raw documents to packed training sequences: toxicity, near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; every result is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from firmlens.llm import jaccard, mixing, packing, tokens, toxicity
from firmlens.session import scratch_path, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER, CAPACITY, END_ID = "byte_bpe_50k.json", 1024, 2
MEMO = 1 << 16  # pieces that a packing worker remembers: its executor still holds what earlier stages left in the heap and in workers
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"  # most whole texts that go to a worker at once
BROADCAST_IDS = 1 << 18  # names of rows (40 bytes each) up to this number are broadcast, more are joined by shuffle


def _named(docs: DataFrame) -> DataFrame:
    """``COLUMNS`` with ``_name``, by which a row is found again: its file (a hash of the path) and its place in it.

    A table of files is not copied for that. A numbering by partitions would not do, as a lost executor changes how files are cut.
    Anything but a table of files is written first.
    """
    name = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_name")
    if docs._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            return docs.select(*COLUMNS, name)
        except AnalysisException:
            pass  # a leaf without files: rows in memory
    return stored(docs.select(*COLUMNS), "rows").select(*COLUMNS, name)


def _small_batches(spark: SparkSession) -> None:
    """Rows with whole texts reach Python workers in batches of ``BATCH_ROWS`` at most, from now on in this session.

    A batch lies in the executor outside its heap and in the worker, on the way there and back. It changes memory, not results.
    """
    rows = int(spark.conf.get(BATCH_SETTING))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def _names(df: DataFrame, label: str) -> DataFrame:
    df = stored(df.select(F.col("_name").alias("_other")).distinct(), label)
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance model does not call toxic.

    The model is fitted on labelled documents of ``docs``; without labels for both kinds every score is the rate of
    toxic labels. NULL and empty texts are judged as empty ones, rows that are repeated alike.
    """
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=[c for c in COLUMNS if c != "doc_id"])
    return scored.where("predicted = 0").select(*COLUMNS)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard similarity of 0.8 and more, links closed.

    Of a group the document with the smallest id stays, one without an id only if none has one. Documents without words are in
    no group and stay. Every row is a document of its own, also if it has no id or repeats one.
    """
    _small_batches(spark)
    rows = _named(docs)
    groups = stored(jaccard.similar_groups(rows, 5, 80, "_name").select("_name", "component_id"), "groups")
    # The first of a group is found by its key, and the others by not being one: no join on the key of a large group.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_name")
    first = groups.join(rows.select("_name", "doc_id"), "_name").groupBy("component_id").agg(F.min(order)["_name"].alias("_name"))
    gone = _names(groups.join(first.select("_name"), "_name", "left_anti"), "gone")
    return rows.join(gone, F.col("_name") == F.col("_other"), "left_anti").select(*COLUMNS)


@F.pandas_udf(StringType())
def first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """Texts up to the end of their first ``counts`` words."""
    word = re.compile(mixing.WORD)

    def cut(text: str, n: int) -> str:
        end = 0
        for k, m in enumerate(word.finditer(text)):
            if k == n:
                break
            end = m.end()
        return text[:end]

    return pd.Series([cut(t, n) for t, n in zip(texts, counts)])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: once for every epoch, those beyond their source's budget not at all.

    The one document of a source in which its budget ends gives its first words only, so that every source has exactly its
    budget of words. Sources weigh 1, 2, 3, repeating, and take at most three epochs. Documents without words are
    taken with every full epoch of their source.
    """
    # A source's order has one border: what lies before it is taken once more than what lies behind it. Rows are held against the
    # border of their source, so that texts are neither shuffled nor copied.
    rows = _named(docs).withColumn("_place", F.struct(*mixing.order_in_source(), "_name"))
    mixed = mixing.mix(rows, keep=["_name", "_place"], tie=["_name"])
    last = F.max(F.when(F.col("part") > 0, F.struct("_place", "part", "size")))
    borders = mixed.groupBy("source").agg(F.max("epochs").alias("_epochs"), last.alias("_last")).withColumnRenamed("source", "_source")
    placed = rows.join(stored(borders, "borders"), F.col("source").eqNullSafe(F.col("_source")))
    at_border = F.col("_place") == F.col("_last._place")
    in_full = (F.col("_place") < F.col("_last._place")) | (at_border & (F.col("_last.part") == F.col("_last.size")))
    once_more = F.when(in_full & F.regexp_like(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)), 1).otherwise(0)
    copies = placed.withColumn("_copies", (F.col("_epochs") + once_more).cast("int")).where("_copies > 0")
    copies = copies.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "_copies"))).select(*COLUMNS)
    cut = placed.where(at_border & (F.col("_last.part") < F.col("_last.size"))).select(*COLUMNS, F.col("_last.part").alias("_part"))
    cut = cut.withColumn("text", first_words("text", "_part")).withColumn("n_chars", F.length("text").cast("long"))
    return copies.unionByName(cut.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each closed by an end id, in as few sequences of 1024 ids as dominance reduction and best fit find."""
    _small_batches(spark)
    pieces = tokens.token_pieces(docs, tokens.public_path(TOKENIZER), CAPACITY, END_ID, memo=MEMO)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_per_group),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Compression lengths have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
