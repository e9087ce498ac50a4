"""The energy tables as views of the generic test tables.

They give every operator an input whose size grows with the given data. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def telemetry(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        (F.col("value") * 20).alias("p_solar"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("double").alias("battery_state"),
        (F.hour("ts") * 100 + F.minute("ts")).cast("int").alias("e_day"),
    )


def consumption(ev: DataFrame) -> DataFrame:
    device = F.col("user_id") % 3
    return ev.select(
        F.col("ts").alias("timestamp"),
        device.cast("int").alias("dev_id"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") * 10).alias("watts"),
        F.lit(230.0).alias("volts"),
        F.when(device == 0, "dishwasher")
        .when(device == 1, "laundry machine")
        .otherwise("")
        .alias("device_location"),
    )


def prices_raw(ev: DataFrame) -> DataFrame:
    """Last value of each 15 minutes; some of them are missing."""
    slot = F.window("ts", "15 minutes").start.cast("timestamp_ntz")
    last = F.max_by("value", F.struct("ts", "event_id"))
    return ev.groupBy(slot.alias("timestamp")).agg((last * 10).alias("price"))


def sun(ev: DataFrame) -> DataFrame:
    """Sunrise and sunset per date; day 17 is missing."""
    day = F.to_date("ts")
    midnight = F.col("date").cast("timestamp_ntz")
    return (
        ev.filter(F.dayofmonth("ts") != 17)
        .groupBy(day.alias("date"))
        .agg(F.lit("fine").alias("summary"))
        .select(
            "date",
            (midnight + F.expr("interval 8 hours")).alias("sunrise"),
            (midnight + F.expr("interval 16 hours")).alias("sunset"),
            "summary",
        )
    )


def production_log(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.date_add(F.to_date("ts"), 20).alias("date")).agg(
        (F.count("*") * 100).cast("double").alias("e_day")
    )


def summary_stored(ev: DataFrame) -> DataFrame:
    """Twenty stored days; the later ten have no estimate and no night charge flag."""
    known = F.dayofmonth("date") <= 10
    return (
        ev.filter(F.dayofmonth("ts") <= 20)
        .groupBy(F.to_date("ts").alias("date"))
        .agg(F.max(F.col("value") * 20).alias("peak_solar"))
        .withColumn("daily_solar_est", F.when(known, 1.0))
        .withColumn("night_grid_charge", F.when(known, False))
    )


def hourly(ev: DataFrame) -> DataFrame:
    """Hourly weather: number of readings stands for the temperature."""
    return ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date")).agg(
        F.count("*").cast("double").alias("temp")
    )
