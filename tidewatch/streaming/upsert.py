"""Continuous ingest: every micro-batch is upserted into the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.windows import keep_last
from tidewatch.sinks.upsert import upsert_table


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files as they land in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_upsert(
    source: DataFrame,
    path: str,
    keys: list[str],
    *,
    sequence: str,
    checkpoint: str,
    mode: str = "replace",
    schema: T.StructType | None = None,
    time: str = "observed_at",
) -> StreamingQuery:
    """Start an upsert of all available input; stops when it is caught up.

    Within a batch the last row of a key by ``sequence`` wins, and a later batch
    wins over an earlier one. So a late or repeated hour replaces the stored one,
    which a watermark that keeps the first arrival could not do. A batch that is
    replayed after a failure writes the same rows again.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        latest = keep_last(batch, keys, sequence).drop(sequence).persist()
        try:
            upsert_table(
                batch.sparkSession, path, latest, keys, mode=mode, schema=schema, time=time
            )
        finally:
            latest.unpersist()

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
