"""Where intermediate tables are written: the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir; only where that is unset, as in tests, below one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'tessera-work')}"
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes the frame and reads it again: a short lineage that lost executors can't undo."""
    folder, schema = workspace(df.sparkSession, name), df.schema
    df.write.parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)
