"""Streams in place of poll loops and nightly jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from homegrid.operators.daily import THRESHOLDS, diary_aggregates
from homegrid.operators.series import dedupe_first, dedupe_last
from homegrid.sinks.keyed import with_partition_date, write_keyed, write_new


def payload_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """One payload per line of the text files which land in ``path``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).withColumnRenamed("value", "body")


def _once(rows: DataFrame, write: Callable[[DataFrame], None]) -> None:
    """A keyed write reads its rows more than once; a micro-batch is parsed only once."""
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write(kept)
    finally:
        kept.unpersist()


def stream_ingest(
    bodies: DataFrame,
    parser: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = ("timestamp",),
    arrival: str | None = None,
    replace: bool = False,
) -> StreamingQuery:
    """Parse the payloads that are there now and store them by key.

    Telemetry keeps the first row of a key, plugs the last. Both writes can be repeated,
    so a batch that runs again after a failure adds nothing. ``arrival`` is a column that
    orders the rows of one batch; it is not stored.
    """

    if replace and not arrival:
        raise ValueError("the last row of a key needs an arrival to be the last by")

    def store(batch: DataFrame, _: int) -> None:
        pick = dedupe_last if replace else dedupe_first
        rows = pick(batch, keys, arrival).drop(arrival) if arrival else batch.dropDuplicates(list(keys))
        write = write_keyed if replace else write_new
        _once(with_partition_date(rows), lambda df: write(df, sink, keys))

    return (
        parser(bodies)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(
    stream: DataFrame, keys: Sequence[str], ts: str = "timestamp", delay: str = "1 hour"
) -> DataFrame:
    """First row of each key within ``delay``; state older than that is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_day_summary(
    stream: DataFrame, delay: str = "1 day", thresholds: Sequence[float] = THRESHOLDS, keys: Sequence[str] = ()
) -> DataFrame:
    """The diary of each UTC day, and of each key such as a site, as the readings come in.

    In update mode a day is emitted again when it changes; in append mode once, when the
    watermark has passed it.
    """
    return (
        stream.withWatermark("timestamp", delay)
        .groupBy(*keys, F.window("timestamp", "1 day"))
        .agg(*diary_aggregates(stream, thresholds))
        .withColumn("date", F.to_date("window.start"))
        .drop("window")
    )


def start_day_summary(days: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = ()) -> StreamingQuery:
    """Keep the table of days, partitioned by month, up to date with the changed ones."""

    def store(batch: DataFrame, _: int) -> None:
        by_month = batch.withColumn("month", F.date_format("date", "yyyy-MM"))
        _once(by_month, lambda df: write_keyed(df, sink, [*keys, "date"], "month"))

    return (
        days.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
