"""Whole files in the shared folder, written by tasks."""

from __future__ import annotations

import uuid

from pyarrow import NativeFile, fs
from pyspark import TaskContext
from pyspark.sql import DataFrame


def put(folder: str, name: str, data: bytes) -> None:
    """Write ``data`` as ``folder/name``: a complete file appears or none, also if two attempts of a task write it."""
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    draft = f"{base}/_draft-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        out.write(data)
    system.move(draft, f"{base}/{name}")


def get(folder: str, name: str) -> NativeFile:
    """A stream of the bytes of ``folder/name``."""
    system, base = _open(folder)
    return system.open_input_stream(f"{base}/{name}", compression=None)


def spread(listed: DataFrame, column: str) -> DataFrame:
    """A list of files with about one file in each task."""
    return listed.repartition(max(1, listed.count()), column)


def attempt_name(kind: str, number: int) -> str:
    """A name that no other attempt of this or another task uses; it sorts by partition and number."""
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():06d}-{number:06d}-{task.taskAttemptId()}"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    folder = folder.rstrip("/")
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
