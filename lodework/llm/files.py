"""Files that tasks write and read themselves, in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from lodework import session


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one; any store that ``pyarrow.fs`` opens by its URI."""
    path = f"{session.shared_dir(spark).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place)
    return path


def attempt_name(suffix: str) -> str:
    """A name no other attempt of a task uses; only names that finished tasks return are ever read."""
    context = TaskContext.get()
    return f"part-{context.partitionId():06d}-{context.taskAttemptId()}{suffix}"


def create(folder: str, name: str):
    store, place = fs.FileSystem.from_uri(folder)
    return store.open_output_stream(f"{place}/{name}", compression=None)  # by default a .gz name would be packed again


def open_file(folder: str, name: str):
    store, place = fs.FileSystem.from_uri(folder)
    return store.open_input_file(f"{place}/{name}")
