"""Daylight and sun times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homegrid.functions.clock import UTC, local_date, local_wall, micros_of_day
from homegrid.operators.joins import spread_join

NO_WEATHER = "No weather data available for today."


def with_daylight(
    hourly: DataFrame, sun: DataFrame, tz: str = UTC, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``during_day``: the clock time is within sunrise..sunset of the same local date.

    A date without sun times counts as night. ``sun`` has one row per date, or per
    date and place with ``keys``.
    """
    times = sun.select(
        *keys,
        F.col("date").alias("_day"),
        micros_of_day("sunrise", tz).alias("_rise"),
        micros_of_day("sunset", tz).alias("_set"),
    )
    clocked = hourly.withColumns({"_day": local_date("date", tz), "_clock": micros_of_day("date", tz)})
    return (
        spread_join(clocked, times, [*keys, "_day"])
        .withColumn(
            "during_day",
            F.coalesce(F.col("_clock").between(F.col("_rise"), F.col("_set")), F.lit(False)),
        )
        .drop("_day", "_clock", "_rise", "_set")
    )


def sun_lookup(sun: DataFrame, date) -> DataFrame:
    """Sun times of one date; always one row, with a default text when there is none."""
    hit = sun.filter(F.col("date") == F.lit(date).cast("date")).limit(1)
    found = hit.agg(
        F.count("*").alias("_n"),
        F.first("sunrise").alias("sunrise"),
        F.first("sunset").alias("sunset"),
        F.first("summary").alias("_summary"),
    )
    return found.select(
        "sunrise",
        "sunset",
        F.when(F.col("_n") > 0, F.col("_summary")).otherwise(NO_WEATHER).alias("summary"),
    )


def sun_clock(found: DataFrame, tz: str = UTC) -> DataFrame:
    """Local clock times of :func:`sun_lookup`, or "unknown"."""

    def clock(name: str):
        return F.coalesce(F.date_format(local_wall(name, tz), "HH:mm:ss"), F.lit("unknown"))

    return found.select(clock("sunrise").alias("sunrise"), clock("sunset").alias("sunset"), "summary")
