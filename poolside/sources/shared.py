"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder is made only for local runs in which nothing is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None and context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="poolside-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return (named or context.getCheckpointDir()).rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder, for operators that use it several times."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)
