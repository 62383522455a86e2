"""Folders that driver and executors share, and files in them that tasks write themselves."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Without that setting a local session gets a folder under the system's temporary one, and the
    setting is made so that later calls agree; a cluster session is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, lost executors cost nothing."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """An output stream to a new file; its folder is made if need be."""
    system, path = _place(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)  # not by the name


def open_stream(uri: str):
    system, path = _place(uri)
    return system.open_input_stream(path, compression=None)


def open_random(uri: str):
    system, path = _place(uri)
    return system.open_input_file(path)
