"""Rows that came too late, as Spark's own progress reports tell of them."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

COLUMNS = "query string, batch bigint, arrived bigint, late bigint, watermark string"


class LateRows(StreamingQueryListener):
    """Adds a row to a table for every batch of which the watermark dropped rows.

    A query goes by its name, or by its id if it has none. A row is counted where it is
    dropped, which is at the first operator that keeps state.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in told.stateOperators)
        if late:
            row = (told.name or str(told.id), told.batchId, told.numInputRows, late,
                   told.eventTime.get("watermark"))
            self.spark.createDataFrame([row], COLUMNS).coalesce(1).write.mode("append") \
                .parquet(self.path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
