"""The daily job: dropped files as an available-now stream, completeness, scoring, idempotent loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from firmlens.functions.constants import DROP_KINDS
from firmlens.operators.aggregates import latest_per_key
from firmlens.operators.prep import drop_missing
from firmlens.sources import sinks


def missing_inputs(arrived: DataFrame, keys: list[str], kind: str = "kind", required: list[str] = DROP_KINDS) -> DataFrame:
    """Inputs that have not arrived per key, as text in fixed order ('' = complete).

    The set is built over kinds (four at most), so it is a small map-side aggregate whatever a drop's size.
    """
    seen = F.collect_set(F.when(F.col(kind).isin(*required), F.col(kind)))
    wanted = F.array(*[F.lit(r) for r in required])
    return arrived.groupBy(*keys).agg(F.array_join(F.array_except(wanted, seen), ",").alias("missing"))


def drop_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files of a drop folder as a stream with a declared schema; partition folders such as day=... become columns."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


#: State is kept in RocksDB and its changes, not its snapshots, go to the checkpoint with every batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None] | None, checkpoint: str, mode: str = "append", state_parts: int | None = None) -> StreamingQuery:
    """Handles everything that has arrived and ends; the checkpoint remembers what was handled.

    Without ``handle`` the stream is run for its state alone. ``state_parts`` is the number of state partitions, fixed with the
    checkpoint's first batch; a state of few numbers needs few. The ended query is returned for its progress.
    """
    spark = stream.sparkSession
    settings = STATE_STORE | ({"spark.sql.shuffle.partitions": str(state_parts)} if state_parts else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(handle) if handle else writer.format("noop")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        query: StreamingQuery = writer.start()
    finally:  # a query keeps the settings it was started with
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    return query


def append_drops(path: str, partition_by: list[str], guard: list[str], run: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: append every row of a load once, in however many batches and files it arrives.

    ``run`` names the stream, by its checkpoint: batches of one stream add to their loads, a replayed batch replaces itself,
    and loads that another stream has written are skipped. Read the table with ``sinks.loaded``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        sinks.append_load(batch, path, guard, partition_by, run, batch_id)

    return handle


def keep_latest(
    path: str, firm: list[str], order: list[str], partition_by: list[str] = (), hash_parts: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch handler: the latest row per firm over all drops, by upsert of each batch's latest rows.

    A row older than the stored one does not replace it, so drops may come late or twice. A batch is compared with the
    partitions it touches only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        descending = [F.col(c).desc() for c in order]
        latest = latest_per_key(batch, firm, descending)
        sinks.upsert(latest, path, firm, list(partition_by), descending, hash_parts, newest=order)

    return handle


def latest_stream(stream: DataFrame, firm: list[str], order: list[str]) -> DataFrame:
    """The latest row per firm as keyed state, for ``run_available(..., None, checkpoint, "update")``.

    A batch writes the changes of its own firms to the checkpoint, however many firms there are. Late and repeated rows do not
    beat the stored one; rows of equal ``order`` go by their other columns. Each task reduces its rows to one per firm before
    they are shuffled.
    """
    rest = [c for c in stream.columns if c not in (*firm, *order)]
    return stream.groupBy(*firm).agg(F.max(F.struct(*order, *rest)).alias("row"))


def read_latest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The table that ``latest_stream`` keeps, read from the state of its last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType[0].name
    return state.select("key.*", F.col(f"value.{value}").alias("row")).select("*", "row.*").drop("row")


def score_latest(
    score: Callable[[DataFrame], DataFrame], firm: list[str], month_parts: list[str], order: list[str], guard: list[str],
) -> Callable[[DataFrame], DataFrame]:
    """Rows of whole loads -> scores of the latest complete row per firm and load."""

    def scored(rows: DataFrame) -> DataFrame:
        return score(latest_per_key(drop_missing(rows, month_parts), [*guard, *firm], [F.col(c).desc() for c in order]))

    return scored
