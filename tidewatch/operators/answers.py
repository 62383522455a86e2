"""Answers of a completion function, kept under their prompt's digest, so that none is asked twice.

The store is a Parquet table with a file per call. Tasks write a file as soon as a call has returned:
what a lost task, a failed job or a killed run had been told stays, and only the rest is asked anew.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.files import file_names, put_rows, read_rows

Complete = Callable[[Sequence[str]], Sequence[str]]

STORED = "key string, answer string, asked_at double, bucket int"
_FILE = pa.schema([("key", pa.string()), ("answer", pa.string()), ("asked_at", pa.float64())])


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


class AnswerStore:
    """Answers in the folder ``path``, which driver and executors share.

    ``batch`` prompts go to the function at once; ``buckets`` folders hold the files, so that a task
    that runs again looks only at what its own prompts may have got.
    """

    def __init__(self, spark: SparkSession, path: str, batch: int = 64, buckets: int = 64) -> None:
        self.spark, self.path, self.batch, self.buckets = spark, path.rstrip("/"), batch, buckets

    def read(self) -> DataFrame:
        """(key, answer): the first answer to each prompt."""
        if any(name.startswith("bucket=") for name in file_names(self.path)):
            rows = self.spark.read.schema(STORED).parquet(self.path)
        else:
            rows = self.spark.createDataFrame([], STORED)
        # two attempts of one task may both have asked
        first = F.min_by("answer", F.struct("asked_at", F.coalesce("answer", F.lit(""))))
        return rows.groupBy("key").agg(first.alias("answer"))

    def ask(self, prompts: DataFrame, complete: Complete) -> int:
        """Ask for the prompts (column ``prompt``) that have no answer yet; how many that were.

        Equal prompts are asked once, NULL is not asked. NULL is an answer like any other.
        """
        path, batch, buckets = self.path, self.batch, self.buckets
        # a task that runs again finds what its earlier attempts have put there under this name
        this_run = uuid.uuid4().hex

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            told: dict[int, set[str]] = {}
            asked = 0
            for frame in frames:
                for bucket, rows in frame.groupby("bucket"):
                    folder = f"{path}/bucket={bucket}"
                    if bucket not in told:
                        told[bucket] = _keys(folder, this_run)
                    rows = rows[~rows["key"].isin(told[bucket])]
                    for k in range(0, len(rows), batch):
                        part = rows.iloc[k : k + batch]
                        _put(folder, this_run, part["key"].tolist(), complete(part["prompt"].tolist()))
                        asked += len(part)
            yield pd.DataFrame({"asked": [asked]})

        key = prompt_key(F.col("prompt"))
        wanted = prompts.where("prompt is not null").select(key.alias("key"), "prompt")
        wanted = wanted.groupBy("key").agg(F.min("prompt").alias("prompt"))
        fresh = wanted.join(self.read(), "key", "left_anti").withColumn(
            "bucket", F.pmod(F.crc32("key"), F.lit(buckets)).cast("int")
        )
        dealt = fresh.repartition(buckets, "bucket").sortWithinPartitions("bucket", "key")
        return dealt.mapInPandas(run, "asked long").agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]

    def answered(self, rows: DataFrame, complete: Complete, name: str = "answer") -> DataFrame:
        """``rows`` (with a column ``prompt``) and their answers; the prompts without one are asked now."""
        self.ask(rows.select("prompt"), complete)
        answers = self.read().select(F.col("key").alias("__key"), F.col("answer").alias("__answer"))
        joined = rows.drop(name).join(answers, prompt_key(F.col("prompt")) == F.col("__key"), "left")
        return joined.withColumnRenamed("__answer", name).drop("__key")


def _keys(folder: str, run: str) -> set[str]:
    names = [n for n in file_names(folder) if n.startswith(run)]
    return {key for n in names for key in read_rows(f"{folder}/{n}", ["key"]).column(0).to_pylist()}


def _put(folder: str, run: str, keys: list[str], answers: Sequence[str | None]) -> None:
    answers = list(answers)
    if len(answers) != len(keys):
        raise ValueError(f"{len(answers)} answers to {len(keys)} prompts")
    table = pa.Table.from_pydict(
        {"key": keys, "answer": answers, "asked_at": [time.time()] * len(keys)}, schema=_FILE
    )
    put_rows(folder, f"{run}-{uuid.uuid4().hex}.parquet", table)
