"""Paths for files that a query writes and reads back."""

from __future__ import annotations

import uuid

from evimap.operators.lineage import shared_folder
from pyspark.sql import SparkSession


def staged(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
