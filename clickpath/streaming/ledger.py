"""A table of what each micro-batch took in and dropped as late.

A progress listener writes one row a micro-batch, so rows behind the watermark
are counted where they vanish.  The row of a batch is a partition of its own:
a batch reported twice (after a restart) replaces its row.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LEDGER_SCHEMA = "batch_id long, input_rows long, dropped_rows long, state_rows long, watermark timestamp, run_id string"


class LateRowLedger(StreamingQueryListener):
    """Writes the progress of the query named ``query_name`` to ``path``; use as a context around the query.

    ``dropped_rows`` counts what the stateful operators dropped behind the
    watermark; a session operator counts rows after it has merged those of one
    key and one time.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str, run_id: str):
        self._spark, self._path, self._name, self._run = spark, path, query_name, run_id
        self._ids: set[str] = set()
        self._ended = threading.Event()
        self._error: Exception | None = None

    def __enter__(self) -> LateRowLedger:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        # events of one query arrive in order: after its end all its progress is written
        if exc[0] is None:
            self._ended.wait(60)
        self._spark.streams.removeListener(self)
        if exc[0] is None and self._error is not None:
            raise self._error

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._ids.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) not in self._ids:
            return
        try:
            dropped = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
            held = sum(o.numRowsTotal for o in p.stateOperators)
            row = [(p.batchId, p.numInputRows, dropped, held, p.eventTime.get("watermark"), self._run)]
            df = self._spark.createDataFrame(row, LEDGER_SCHEMA.replace("watermark timestamp", "watermark string"))
            (df.withColumn("watermark", F.to_timestamp("watermark")).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(self._path))
        except Exception as e:  # a listener may not stop the stream; the context raises it
            self._error = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._ids:
            self._ended.set()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)
