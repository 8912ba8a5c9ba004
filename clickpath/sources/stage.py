"""Write an intermediate table once to the shared work folder and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import work_path
from .lake import _fs_path


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's file system client remove ``path`` when the application ends."""
    fs, p = _fs_path(spark, path)
    fs.deleteOnExit(p)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a finished Parquet write beside the checkpoint folder.

    Cuts the lineage: what reads the result several times does not compute the
    input again, and a lost executor re-reads files that all of them share.
    The files go when the application ends.
    """
    spark = df.sparkSession
    path = work_path(spark, "stage", f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(schema).parquet(path)
