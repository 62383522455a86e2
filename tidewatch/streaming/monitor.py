"""Continuous measurement: re-measure a table whenever rows arrive.

A measurement covers the whole table, not the rows that just arrived. The stream therefore keeps the
suite's per-date partial aggregates as its state, and each measurement merges them. For keyed checks
Spark's state store knows the keys seen so far; only the number of new ones in each batch is added
up, so a measurement reads one number however many keys there are. State and progress are kept with
each batch (see ``tidewatch.streaming.state``): a repeated or resumed batch counts once, and a run
that was killed goes on, or is measured, where its last finished batch ended.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.functions.numeric import wall_clock
from tidewatch.operators.checks import KeyedCheck, cardinality, duplicate_count
from tidewatch.operators.suite import ROWS, Suite, measure_partials
from tidewatch.session import shared_folder
from tidewatch.sources.tables import append_measurements, read_measurements
from tidewatch.streaming.state import FORMAT, StateSink, kept_state, newest_batch


def stream_table(
    spark: SparkSession,
    path: str,
    schema,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A parquet folder (or pattern) as a stream: rows of new files arrive as they appear."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def key_numbers(keyed: list[int]) -> StructType:
    """State of the keys: how many different ones each binding has seen."""
    return StructType([StructField(f"keys_{i}", LongType()) for i in keyed])


@dataclass
class Monitor:
    """The running queries of one suite over one stream."""

    spark: SparkSession
    suite: Suite
    folder: str
    partials: StreamingQuery
    schema: StructType
    keys: StreamingQuery | None
    keyed: list[int]

    @property
    def queries(self) -> list[StreamingQuery]:
        return [self.partials] if self.keys is None else [self.partials, self.keys]

    @property
    def identity(self) -> str:
        """The same for all runs that go on in one folder, and of no other monitor."""
        return hashlib.sha256(self.folder.encode()).hexdigest()[:16]

    def wait(self) -> Monitor:
        """Wait for queries that end by themselves (available data only)."""
        for query in self.queries:
            query.awaitTermination()
        return self

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def _distinct(self, i: int) -> bool:
        return self.suite.bindings[i].check is cardinality

    def last_batch(self) -> int | None:
        """Number of the last finished batch with rows, of this run or an earlier one."""
        return newest_batch(f"{self.folder}/state")

    def _quiet(self) -> bool:
        """Whether no query is in the middle of a batch."""
        return not any(q.isActive and q.status["isTriggerActive"] for q in self.queries)

    def state(self) -> DataFrame:
        """The per-date partial aggregates after the last finished batch."""
        return kept_state(self.spark, f"{self.folder}/state", self.schema)

    def measure(self, measured_at) -> DataFrame:
        """Measurement rows of the whole table as streamed so far."""
        at = wall_clock(measured_at)
        state = self.state()
        parts = []
        if any(not isinstance(b.check, KeyedCheck) for b in self.suite.bindings):
            parts.append(measure_partials(state, self.suite, measured_at))
        if self.keyed:
            keys = kept_state(self.spark, f"{self.folder}/keys", key_numbers(self.keyed))
            numbers = keys.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in keys.columns))
            rows = self.suite.whole_rows(state).agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias("rows"))
            wide = rows.crossJoin(F.broadcast(numbers)).select(*(
                (F.col(f"keys_{i}") if self._distinct(i) else F.col("rows") - F.col(f"keys_{i}")).alias(f"m{i}")
                for i in self.keyed
            ))
            parts.append(self.suite.rows_of(wide, self.keyed, at))
        return reduce(DataFrame.unionByName, parts)


def start_monitor(
    stream: DataFrame,
    suite: Suite,
    folder: str | None = None,
    every: str | None = None,
) -> Monitor:
    """Start measuring a stream.

    ``every=None`` works off the rows that are there and ends; ``every="60 minutes"`` keeps running
    at that interval. ``folder`` holds state and progress; reuse it to go on where a run ended. By
    default a new folder under ``spark.checkpoint.dir`` is taken.
    """
    spark = stream.sparkSession
    if folder is None:
        folder = f"{shared_folder(spark)}/monitor-{uuid.uuid4().hex}"
    trigger = {"processingTime": every} if every else {"availableNow": True}
    spark.dataSource.register(StateSink)

    def kept(frame: DataFrame, mode: str, state: str, progress: str) -> StreamingQuery:
        return (
            frame.writeStream.outputMode(mode).format(FORMAT).option("folder", f"{folder}/{state}")
            .option("checkpointLocation", f"{folder}/{progress}").trigger(**trigger).start()
        )

    def once_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a stream's deduplication shuffles every row by its key; copies of a key are dropped here
        # first, so that a key with very many rows does not end up in one task
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield from table.group_by(table.column_names).aggregate([]).to_batches()

    keyed = [i for i, _ in suite.of_family(KeyedCheck)]
    for i in keyed:
        if suite.bindings[i].check not in (cardinality, duplicate_count):
            raise ValueError(f"{suite.bindings[i].check.name} has no streaming form")
    keys = None
    if keyed:
        filled_only = {i for i in keyed if suite.bindings[i].check is cardinality}

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = dict.fromkeys(keyed, 0)
            for batch in batches:
                table = pa.table({"binding": batch["binding"], "filled": batch["filled"].cast(pa.int64())})
                sums = table.group_by("binding").aggregate([("filled", "count"), ("filled", "sum")])
                for row in sums.to_pylist():
                    i = row["binding"]
                    n[i] += row["filled_sum" if i in filled_only else "filled_count"]
            yield pa.RecordBatch.from_pydict({f"keys_{i}": pa.array([k], pa.int64()) for i, k in n.items()})

        rows = suite.key_rows(stream, keyed)
        new = rows.mapInArrow(once_per_batch, rows.schema).dropDuplicates()
        keys = kept(new.mapInArrow(counted, key_numbers(keyed)), "append", "keys", "keys-progress")
    partials = suite.partials(stream, count_rows=True)
    query = kept(partials, "complete", "state", "partials")
    return Monitor(spark, suite, folder, query, partials.schema, keys, keyed)


def keep_measuring(
    monitor: Monitor,
    log_path: str,
    clock: Callable[[], dt.datetime],
    poll_seconds: float = 1.0,
) -> None:
    """Append a measurement to the history after every trigger with rows, until the queries end.

    Rows carry the batch number, and measuring a batch again replaces its rows. A measurement is taken
    when all queries of the monitor have finished the trigger, so that they have seen the same rows.
    The first batch measured may be one that an earlier run finished and did not live to measure.
    """
    earlier = read_measurements(monitor.spark, log_path).where(F.col("monitor") == monitor.identity)
    done = earlier.agg(F.max("batch_id")).first()[0]
    while True:
        running = any(q.isActive for q in monitor.queries)
        for query in monitor.queries:  # a dead part would freeze its share of each measurement
            if (error := query.exception()) is not None:
                monitor.stop()
                raise error
        newest = monitor.last_batch()
        if newest is not None and newest != done and monitor._quiet():
            append_measurements(monitor.measure(clock()), log_path, newest, monitor.identity)
            done = newest
        if not running:
            return
        time.sleep(poll_seconds)
