"""Streams: claims appended to a ledger, and the latest state of synchronised records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verbarium.operators.workspace import last_write_wins


def read_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_claims(stream: DataFrame, to_claims: Callable[[DataFrame], DataFrame], ledger: str, checkpoint: str) -> StreamingQuery:
    """Turns what has arrived into claims and appends it to the ledger, then stops.

    The checkpoint says what has been read, so a restart continues and a batch is written once.
    """
    return to_claims(stream).writeStream.format("parquet").option("path", ledger).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def sync_records(stream: DataFrame, key: str, version: str, state: str, checkpoint: str) -> StreamingQuery:
    """Last write wins over a stream of records: each batch makes the next state folder ``state/v<batch>``.

    A batch that is run again writes the same folder from the same one before, so a restart changes nothing.
    """

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r")).select(key, "_r.*").select(*batch.columns)
        old = spark.read.schema(batch.schema).parquet(f"{state}/v{n - 1}") if n else newest.limit(0)
        last_write_wins(old, newest, key, version).write.mode("overwrite").parquet(f"{state}/v{n}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per event-time window and key; what comes later than ``late`` is not counted."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))
