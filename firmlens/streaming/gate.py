"""Releases a load when all of its inputs have arrived in full, and reports those that stay incomplete.

A load (``keys``: task_date, econ) has several kinds of input. Each kind is announced with its number of rows; rows and
announcements come in any order, in any number of files and batches. Rows are counted inside the task that reads
them, so the keyed state holds two numbers per load and kind and a hot load costs its tasks one row each. The rows themselves stay in
the drop folder until their load is released.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from firmlens.functions.constants import DROP_KINDS
from firmlens.sources import sinks

RELEASED, TIMED_OUT, LATE = "released", "timed out", "late rows"
EVENT_COLUMNS = "status string, missing string, n_rows long"


def _counted(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by([*keys, "kind"]).aggregate([([], "count_all"), ("arrived", "max")])
                yield from table.select([*keys, "kind", "arrived_max", "count_all"]).rename_columns([*keys, "kind", "arrived", "seen"]).combine_chunks().to_batches()

    return count


def arrivals(rows: DataFrame, announced: DataFrame, keys: list[str]) -> DataFrame:
    """What has arrived: (keys, kind, arrived, seen, expected), one row per load, kind and Arrow batch of rows.

    ``rows`` has the keys, ``kind`` and ``arrived`` beside its own columns, ``announced`` has keys, ``kind``, ``arrived`` and ``n_rows``.
    An announcement without a kind only moves the clock.
    """
    slim = rows.select(*keys, "kind", "arrived")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema)
    counts = slim.mapInArrow(_counted(keys), f"{fields}, seen long").withColumn("expected", F.lit(None).cast("long"))
    told = announced.select(*keys, "kind", "arrived", F.lit(0).cast("long").alias("seen"), F.col("n_rows").cast("long").alias("expected"))
    return counts.unionByName(told)


class ReleaseGate(StatefulProcessor):
    """State of one load: rows seen and expected per kind, and whether it was released or reported.

    A load is released once, with the batch in which the last of its kinds has as many rows as announced. ``timeout`` after its first
    arrival an incomplete load is reported with its missing kinds; should it become complete later, it is still released. Rows
    beyond the announced ones are reported as late, never dropped without a word.
    """

    def __init__(self, required: list[str], timeout: timedelta) -> None:
        self.required, self.timeout_ms = required, int(timeout.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "kind string", "seen long, expected long")
        self.status = handle.getValueState("status", "released boolean, reported boolean")

    def _event(self, key: tuple, status: str, missing: str, n_rows: int) -> pd.DataFrame:
        return pd.DataFrame({"load": [key[0]], "status": [status], "missing": [missing], "n_rows": [n_rows]})

    def _standing(self) -> tuple[str, int]:
        """Missing kinds in their fixed order, and the rows seen."""
        known = {k[0]: v for k, v in self.counts.iterator()}
        missing = [k for k in self.required if k not in known or known[k][1] is None or known[k][0] < known[k][1]]
        return ",".join(missing), sum(v[0] for v in known.values())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        expected: dict[str, int] = {}
        first = None
        for frame in rows:
            for kind, n, told, arrived in zip(frame["kind"], frame["seen"], frame["expected"], frame["arrived"]):
                if kind in self.required:
                    seen[kind] = seen.get(kind, 0) + int(n)
                    if not pd.isna(told):
                        expected[kind] = int(told)
                    first = arrived if first is None else min(first, arrived)
        if first is None:
            return
        for kind, n in seen.items():
            old = self.counts.getValue((kind,)) if self.counts.containsKey((kind,)) else (0, None)
            self.counts.updateValue((kind,), (old[0] + n, expected.get(kind, old[1])))
        released, reported = self.status.get() if self.status.exists() else (False, None)
        if reported is None:
            reported = False
            self.handle.registerTimer(int(first.timestamp() * 1000) + self.timeout_ms)
        missing, total = self._standing()
        if released and sum(seen.values()):
            yield self._event(key, LATE, "", sum(seen.values()))
        elif not released and not missing:
            released = True
            yield self._event(key, RELEASED, "", total)
        self.status.update((released, reported))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        released, reported = self.status.get()
        if not released and not reported:
            self.status.update((False, True))
            missing, total = self._standing()
            yield self._event(key, TIMED_OUT, missing, total)

    def close(self) -> None:
        pass


def release_events(arrived: DataFrame, keys: list[str], timeout: timedelta, required: list[str] = DROP_KINDS, delay: str = "0 seconds") -> DataFrame:
    """A streaming frame of (keys, status, missing, n_rows) from ``arrivals``. Needs the RocksDB state store.

    Time is the time of arrival. ``delay`` is how far the clocks of writers may differ: what arrives with an older stamp than
    the newest one less ``delay`` is not counted, so its load stays incomplete and is reported.
    """
    # One text is the state's key: NULLs among several keys would not survive their way through pandas.
    fields = arrived.select(*keys).schema
    named = arrived.withColumn("load", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})).drop(*keys)
    events = named.withWatermark("arrived", delay).groupBy("load").transformWithStateInPandas(ReleaseGate(required, timeout), f"load string, {EVENT_COLUMNS}", "Append", "EventTime")
    return events.withColumn("load", F.from_json("load", fields)).select("load.*", "status", "missing", "n_rows")


def load_released(
    sources: dict[str, DataFrame], keys: list[str], targets: dict[str, Callable[[dict[str, DataFrame]], DataFrame]], events: str,
) -> Callable[[DataFrame, int], None]:
    """Batch handler for ``release_events``: writes the rows of released loads to every target, and all events to ``events``.

    ``sources`` are the drop folders as batch frames by name, partitioned by keys so that only folders of released loads are
    read. A target function turns the rows of whole loads into those of its table. Tables have a folder per load, which a
    replay replaces, so a batch may be handled any number of times. Events are written first, as the stateful plan must run
    once per batch only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = F.lit(batch_id).cast("long")
        batch.withColumn("batch_", mark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_").parquet(events)
        written = spark.read.schema(batch.withColumn("batch_", mark).schema).parquet(events)
        # Keys of the loads that this batch completes, one row each.
        found = written.where((F.col("batch_") == batch_id) & (F.col("status") == RELEASED)).select(*keys).collect()
        if found:
            rows = {name: sinks.rows_of(df, found, keys, spark) for name, df in sources.items()}
            for path, make in targets.items():
                # One file per load, and several where a load is large.
                out = make(rows).hint("rebalance", *keys)
                out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)

    return handle
