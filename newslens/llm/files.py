"""Files that tasks write to and read from the shared folder.

A task gives every file a name of its own and returns it in a row; the rows are written by
Spark, so that only files of tasks that succeeded are ever read.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame


def at(uri: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def write(folder: str, suffix: str, parts: list[bytes]) -> str:
    """Write one file of several parts under a new name; its URI."""
    fs, path = at(folder)
    fs.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.{suffix}"
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
        for part in parts:
            out.write(part)
    return f"{folder}/{name}"


def read(uri: str) -> bytes:
    fs, path = at(uri)
    with fs.open_input_stream(path, compression=None) as source:
        return source.read()


def dealt(manifest: DataFrame) -> DataFrame:
    """A row per file, dealt to as many tasks."""
    return manifest.repartition(max(1, manifest.count()))
