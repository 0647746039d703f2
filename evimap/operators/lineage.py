"""Where results are kept so that later steps do not compute them again, and how rows are dealt to tasks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only for local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def many(spark: SparkSession) -> int:
    """Tasks for rows of few bytes and much work, which adaptive execution would put together by their bytes."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows of a task where rows are sorted or hashed by key.  Narrow rows take twenty times the bytes in memory that they take in a shuffle file.
TASK_ROWS = 500_000


def tasks_for(rows: DataFrame, of: int | None = None) -> int:
    """Number of partitions that keeps the rows of a task, and so its memory, the same however large a table is; counted from the footers of its files."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (of or TASK_ROWS)))


def settle(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared folder, which survives the loss of an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``settle``, but as files of a known size, so that a join can see whether it is small."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
