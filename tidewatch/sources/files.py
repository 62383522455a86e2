"""Files that tasks or the driver write themselves, on any file system that Arrow knows."""

from __future__ import annotations

import posixpath

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def file_names(folder: str) -> list[str]:
    """Names in a folder, none if it doesn't exist."""
    system, path = place(folder)
    return [f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]


def read_rows(uri: str, columns: list[str] | None = None) -> pa.Table:
    system, path = place(uri)
    with system.open_input_file(path) as file:
        return pq.read_table(file, columns=columns)


def put_rows(folder: str, name: str, rows: pa.Table) -> None:
    """Write a Parquet file that readers see whole or not at all."""
    system, path = place(folder)
    system.create_dir(path, recursive=True)
    hidden = posixpath.join(path, f"_{name}")
    with system.open_output_stream(hidden) as file:
        pq.write_table(rows, file)
    system.move(hidden, posixpath.join(path, name))
