"""Cut lineage with Parquet tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from clickpath.config import checkpoint_dir
from clickpath.sources.stage import delete_at_exit


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    The files are shared by all executors, so a lost executor costs only the
    tasks it was running, and nothing upstream is computed again.  The returned
    frame is lazy, so they stay until the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/clickpath-llm/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(schema).parquet(path)
