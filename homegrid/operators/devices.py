"""Smart-plug readings by device."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homegrid.functions.clock import epoch_seconds, from_seconds
from homegrid.operators.joins import spread_join

MEAN_COLUMNS = ("amps", "watts", "volts")


def device_readings(df: DataFrame, dev_id: int | None = None) -> DataFrame:
    """Readings of devices with a location, or of one such device."""
    located = df.filter(F.col("device_location") != "")
    return located if dev_id is None else located.filter(F.col("dev_id") == dev_id)


def device_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("dev_id", "device_location")
        .agg(F.count("*").alias("n"))
        .orderBy(F.asc("dev_id"), F.desc("device_location"))
    )


def device_location(df: DataFrame) -> DataFrame:
    """First location seen of each device, by way of one row per distinct location."""
    return (
        df.groupBy("dev_id", "device_location")
        .agg(F.min("timestamp").alias("_since"))
        .groupBy("dev_id")
        .agg(F.min_by("device_location", F.struct("_since", "device_location")).alias("device_location"))
    )


def label_devices(df: DataFrame, mapping: DataFrame | dict[int, str]) -> DataFrame:
    """Set the location of the devices in ``mapping``; others keep theirs.

    A dict becomes a literal lookup. A table of one row per device is joined; its counted size
    decides how, and a device with most of the readings is spread over many tasks either way.
    """
    if isinstance(mapping, dict):
        pairs = [F.lit(x) for x in chain.from_iterable(mapping.items())]
        label = F.try_element_at(F.create_map(*pairs), F.col("dev_id"))
        return df.withColumn("device_location", F.coalesce(label, "device_location"))
    labels = mapping.select("dev_id", F.col("device_location").alias("_label"))
    return (
        spread_join(df, labels, ["dev_id"])
        .withColumn("device_location", F.coalesce("_label", "device_location"))
        .select(*df.columns)
    )


def second_means(df: DataFrame, keys=("dev_id",), columns=None) -> DataFrame:
    """Mean of the measured columns per key and second."""
    columns = columns or [c for c in MEAN_COLUMNS if c in df.columns]
    return (
        df.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, epoch_seconds("timestamp").alias("_sec"))
        .agg(*[F.avg(c).alias(c) for c in columns])
        .select(*keys, from_seconds("_sec").alias("timestamp"), *columns)
    )
