"""Tables between jobs: written where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; in local mode without that setting, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _own[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/tallyhouse/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote and nothing reads any more."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


class Spool:
    """Writes intermediate tables as Parquet, which cuts lineage and survives lost executors.

    `write` returns the table as read back. `drop` deletes tables whose readers have all been written.
    Tables that a lazy result still reads stay until the shared folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = new_folder(spark, name)
        self.paths: dict[int, str] = {}
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete(self.spark, self.paths.pop(id(table)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
