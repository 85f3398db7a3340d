"""Batch ingest: write the logical tables as typed Parquet for later jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.tables import NATIVE, Tables

_own: dict[str, str] = {}


def write_native(tables: Tables, folder: str, mode: str = "errorifexists") -> None:
    """Write the five tables to ``<folder>/<table>`` as Parquet.

    No shuffle: each task writes what it has read. ``layout.write_layout`` stores orders
    and lines side by side instead, where no order is too large for that.
    """
    for name, schema in NATIVE.items():
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        getattr(tables, name).select(*typed).write.mode(mode).parquet(f"{folder}/{name}")


def new_folder(spark: SparkSession) -> str:
    """A path that nothing has used, below the folder of ``spark.checkpoint.dir``.

    Local mode without that setting has a folder of its own; a cluster must name one that
    all executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="tallyhouse-")
        folder = _own[context.applicationId]
    return f"{folder.rstrip('/')}/tallyhouse/ingest-{uuid.uuid4().hex}"
