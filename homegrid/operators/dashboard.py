"""Reads behind the dashboard: battery, gauge and forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homegrid.functions.clock import span_seconds

BATTERY_ROWS = 1000
FORECAST_ROWS = 250
FORECAST_DAYS = 3


def _level() -> Column:
    level = F.greatest(F.least(F.col("battery_state_norm"), F.lit(100.0)), F.lit(0.0))
    return F.when(F.col("battery_state_norm").isNotNull(), level)


def _top(df: DataFrame, order: Column, limit: int, keys: Sequence[str]) -> DataFrame:
    """The first ``limit`` rows in order, of the table or of each key."""
    if not keys:
        return df.orderBy(order).limit(limit)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")


def battery_latest(df: DataFrame, limit: int = BATTERY_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """The newest readings of the normalised battery state, clipped to 0..100."""
    rows = df.select(*keys, "timestamp", "battery_state_norm")
    return _top(rows, F.desc("timestamp"), limit, keys).withColumn("battery_state_norm", _level())


def battery_gauge(
    df: DataFrame, lookback: str = "1 hour", keys: Sequence[str] = ()
) -> DataFrame:
    """Battery now, the oldest reading within ``lookback`` of it, and the difference.

    Works on the whole table, however many readings an hour has: the newest time is read
    first and bounds the scan; with keys, each has its own.
    """
    span = F.make_dt_interval(secs=F.lit(span_seconds(lookback)))
    if keys:
        newest = df.groupBy(*keys).agg(F.max("timestamp").alias("_newest"))
        recent = df.join(newest, list(keys)).filter(F.col("timestamp") > F.col("_newest") - span)
    else:
        newest = df.agg(F.max("timestamp") - span).scalar()
        recent = df.filter(F.col("timestamp") > newest)
    recent = recent.withColumn("battery_state_norm", _level())
    return recent.groupBy(*keys).agg(
        F.max_by("battery_state_norm", "timestamp").alias("battery_pct"),
        F.min_by("battery_state_norm", "timestamp").alias("battery_pct_before"),
    ).withColumn("delta", F.col("battery_pct") - F.col("battery_pct_before"))


def forecast_view(
    df: DataFrame, base, days: int = FORECAST_DAYS, limit: int = FORECAST_ROWS, keys: Sequence[str] = ()
) -> DataFrame:
    """Forecast rows of ``[base, base + days)`` in time order."""
    kind = df.schema["timestamp"].dataType
    start = F.lit(base).cast("date")
    rows = df.filter(
        (F.col("timestamp") >= start.cast(kind))
        & (F.col("timestamp") < F.date_add(start, days).cast(kind))
    ).select(*keys, "timestamp", "pv_estimate", "pv_estimate10", "pv_estimate90")
    return _top(rows, F.asc("timestamp"), limit, keys)


def forecast_series(view: DataFrame) -> DataFrame:
    """The forecast under the names of its three curves."""
    return view.withColumnsRenamed(
        {"pv_estimate": "Estimate", "pv_estimate10": "Pessimistic", "pv_estimate90": "Optimistic"}
    )
