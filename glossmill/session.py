"""Session bootstrap."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession


def get_session(app_name: str = "glossmill", **conf: str) -> SparkSession:
    """Return the running session, or build one.

    Keyword names use `__` for the dots of a Spark setting:
    `get_session(spark__sql__shuffle__partitions="64")`.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside a `with` block, and are put back after it.

    What was unset is unset again, also where the block fails. Spark plans a query when its
    result is asked for, so the action has to be inside the block. A session has one set of
    settings: give threads that run such blocks at once a session each.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def split_settings(spark: SparkSession) -> dict[str, str]:
    """Settings that keep file splits the same for all scans inside a `settings` block.

    On inputs small enough that a split is total bytes / cores, Spark takes the
    core count at planning time, so two scans of one file are cut differently
    when executors join or leave between them. Block grouping scans several times and
    matches the scans on split offsets; where they differ it fails.
    """
    key = "spark.sql.files.minPartitionNum"
    given = spark.conf.get(key, None)
    return {key: given or str(spark.sparkContext.defaultParallelism)}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that every executor can reach.

    That is the folder `spark.checkpoint.dir` names. Only on a local master, as in
    a test session, a temporary folder takes its place where it is unset: executors
    of a cluster would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all nodes of {master} share")
        base = _temporary_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=None)
def _temporary_folder() -> str:
    return tempfile.mkdtemp(prefix="glossmill-")
