"""Pieces that several training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that part words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Spark's limit of a batch that goes to a Python worker, and what it is here. Without one, 10,000 whole texts
#: lie in an executor several times at once, outside its heap and in each of its workers.
LIMIT, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def in_small_batches(spark: SparkSession) -> None:
    """From now on rows reach Python in batches of about ``BATCH`` bytes; a limit that the session has stays."""
    if spark.conf.get(LIMIT, None) is None:
        spark.conf.set(LIMIT, BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Where a session on one machine has none (tests), a folder is made and set; on a
    cluster that is an error, as executors would not see each other's files.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        set_one = spark.sparkContext._jsc.sc().getCheckpointDir()
        there = set_one.get() if set_one.isDefined() else None
    if not there:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        there = os.path.join(tempfile.gettempdir(), "loomgraph-shared")
        spark.sparkContext.setCheckpointDir(there)
    return there


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This cuts lineage: a lost executor costs a re-read, not a re-run. The table's
    name is unique to the call, so concurrent runs don't meet.
    """
    return written_at(df, label, *by)[0]


def written_at(df: DataFrame, label: str, *by: str) -> tuple[DataFrame, str]:
    """The written table and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loom-{label}-{uuid.uuid4().hex}"
    if not by:
        df.write.parquet(path)
    else:
        # A task keeps a file open for each of a few folders, where it would sort its rows by folder first.
        writers = spark.conf.get(WRITERS, None)
        spark.conf.set(WRITERS, "4")
        try:
            df.write.partitionBy(*by).parquet(path)
        finally:
            spark.conf.unset(WRITERS) if writers is None else spark.conf.set(WRITERS, writers)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing will read again."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


class Scratch:
    """Written tables of one computation, and broadcasts, let go at its end or before.

    What a computation returns must read none of them: it is written outside.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.sent = spark, {}, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for _, path in self.paths.values():
            removed(self.spark, path)
        for value in self.sent:
            value.unpersist()

    def written(self, df: DataFrame, label: str, *by: str) -> DataFrame:
        out, path = written_at(df, label, *by)
        self.hold(out, path)
        self.sent, free = [], self.sent  # what was sent for this table's making isn't needed again
        for value in free:
            value.unpersist()
        return out

    def hold(self, table: DataFrame, path: str) -> None:
        """Let ``path`` go with the others; ``table`` names it and lives as long, so no other has its id."""
        self.paths[id(table)] = (table, path)

    def broadcast(self, value: object) -> Broadcast:
        """``value`` for all executors, until the next table is written."""
        self.sent.append(self.spark.sparkContext.broadcast(value))
        return self.sent[-1]

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if held := self.paths.pop(id(table), None):
                removed(self.spark, held[1])


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; null stays null. ``lower`` does just that on pure ASCII, faster."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower())
    )
