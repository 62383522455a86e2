"""A sink that keeps a stream's state: what each finished batch left behind, for later runs to read.

A batch counts as finished only when its state is kept, so a run that ends at any moment leaves a
state that belongs to its last finished batch; a batch that runs again replaces what it left. What
reaches the driver is a line per calendar date or a number per task.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidewatch.sources.files import place

FORMAT = "tidewatch_state"


def _kept(folder: str) -> list[tuple[int, str]]:
    """(batch, file name) of the states in a folder, oldest first."""
    system, path = place(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = [f.base_name for f in found if f.base_name.startswith("batch-")]
    return sorted((int(n.removeprefix("batch-").removesuffix(".parquet")), n) for n in names)


@dataclass
class _Rows(WriterCommitMessage):
    batches: list[pa.RecordBatch]


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, folder: str, replaces: bool):
        self.folder, self.replaces = folder, replaces

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Rows:
        return _Rows([batch for batch in iterator if batch.num_rows])

    def commit(self, messages: list[_Rows | None], batchId: int) -> None:
        batches = [b for m in messages if m is not None for b in m.batches]
        kept = _kept(self.folder)
        system, path = place(self.folder)
        earlier = [name for batch, name in kept if batch < batchId]
        if not self.replaces and earlier:  # numbers add up over the batches
            with system.open_input_file(posixpath.join(path, earlier[-1])) as file:
                batches += pq.read_table(file).to_batches()
        if not batches and not self.replaces:
            return
        if batches:
            schema = batches[0].schema
            table = pa.Table.from_batches([b.cast(schema) for b in batches])
            if not self.replaces:
                sums = [table.column(k) for k in range(table.num_columns)]
                table = pa.table(
                    {f.name: [pc.sum(c).as_py()] for f, c in zip(schema, sums, strict=True)}, schema
                )
            system.create_dir(path, recursive=True)
            part = posixpath.join(path, f"part-{uuid.uuid4().hex}")
            pq.write_table(table, part, filesystem=system)
            system.move(part, posixpath.join(path, f"batch-{batchId:012d}.parquet"))
        for _, name in kept[:-2]:  # the newest and, should its batch run again, the one before
            system.delete_file(posixpath.join(path, name))

    def abort(self, messages: list[_Rows | None], batchId: int) -> None:
        pass


class StateSink(DataSource):
    """Option ``folder``. In complete mode a batch's rows are the state; else its one row is added to it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["folder"], overwrite)


def newest_batch(folder: str) -> int | None:
    kept = _kept(folder)
    return kept[-1][0] if kept else None


def kept_state(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The state after the last finished batch; empty if there was none."""
    kept = _kept(folder)
    if not kept:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{kept[-1][1]}")
