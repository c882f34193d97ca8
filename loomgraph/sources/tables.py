"""Results that several steps read, written once where all executors see them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where a session on one machine has none, a folder is made and set. On a cluster that is an error."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        there = chosen.get() if chosen.isDefined() else None
    if not there:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        there = os.path.join(tempfile.gettempdir(), "loomgraph-shared")
        spark.sparkContext.setCheckpointDir(there)
    return there


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table of its own name and read again: computed once, and a lost executor costs a re-read."""
    path = f"{shared_folder(df.sparkSession)}/loom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
