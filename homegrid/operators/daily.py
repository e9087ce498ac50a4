"""Daily diary: production times, battery range and snapshots, energy, backfills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homegrid.functions.clock import (
    UTC,
    clock_seconds,
    day_start,
    local_date,
    micros_of_day,
)
from homegrid.functions.energy import normalize_soc
from homegrid.operators.series import energy_daily

THRESHOLDS = (50, 1000, 2000)
THRESHOLD_NAMES = ("prod", "1kw", "2kw")
SNAPSHOTS = ("01:00", "05:00")
SNAPSHOT_NAMES = ("battery_at_1am", "battery_at_5am")
SNAPSHOT_BEFORE = "08:00"


def diary_aggregates(df: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> list[Column]:
    """The diary as plain min/max aggregates of one grouping, with no self-joins."""
    norm = (
        F.col("battery_state_norm")
        if "battery_state_norm" in df.columns
        else normalize_soc("battery_state")
    )
    aggs = [
        F.min("battery_state").alias("min_battery_raw"),
        F.max("battery_state").alias("max_battery_raw"),
        F.min(norm).alias("min_battery"),
        F.max(norm).alias("max_battery"),
    ]
    for name, floor in zip(THRESHOLD_NAMES, thresholds):
        above = F.when(F.col("p_solar") >= floor, F.col("timestamp"))
        aggs += [F.min(above).alias(f"first_{name}"), F.max(above).alias(f"last_{name}")]
    return aggs + [
        F.max("p_solar").alias("peak_solar"),
        F.coalesce(F.max("e_day").cast("int"), F.lit(0)).alias("daily_total"),
    ]


def snapshot_aggregates(
    at: Sequence[str] = SNAPSHOTS, before: str = SNAPSHOT_BEFORE, tz: str = UTC
) -> list[Column]:
    """Battery state at the reading nearest to each clock time, of those before ``before``.

    The order is one number (distance, then the earlier side), so that the aggregate
    keeps fixed-width state. Of two readings at equal distance the earlier one wins.
    """
    clock = micros_of_day("timestamp", tz)
    early = clock < clock_seconds(before) * 1_000_000
    aggs = []
    for name, text in zip(SNAPSHOT_NAMES, at):
        target = clock_seconds(text) * 1_000_000
        order = F.abs(clock - target) * 2 + (clock > target).cast("long")
        nearest = F.min_by("battery_state", F.when(early, order))
        aggs.append(F.coalesce(nearest, F.lit(0.0)).alias(name))
    return aggs


def _by_day(df: DataFrame, keys: Sequence[str], tz: str):
    return df.filter(F.col("timestamp").isNotNull()).groupBy(
        *keys, local_date("timestamp", tz).alias("date")
    )


def day_summary(
    telemetry: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    tz: str = UTC,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per day: battery range, first/last time over each threshold, peak and total."""
    return _by_day(telemetry, keys, tz).agg(*diary_aggregates(telemetry, thresholds))


def battery_snapshot(
    telemetry: DataFrame,
    at: Sequence[str] = SNAPSHOTS,
    before: str = SNAPSHOT_BEFORE,
    tz: str = UTC,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per day: battery state nearest to 01:00 and 05:00, 0 where there is none."""
    return _by_day(telemetry, keys, tz).agg(*snapshot_aggregates(at, before, tz))


def night_charge_flag(margin: float = 10) -> Column:
    one, five = (F.coalesce(F.col(n), F.lit(0.0)) for n in SNAPSHOT_NAMES)
    return one + margin < five


def night_charge(snapshots: DataFrame, margin: float = 10) -> DataFrame:
    """Was the battery charged from the grid in the night?"""
    return snapshots.withColumn("night_grid_charge", night_charge_flag(margin))


def incremental_days(
    df: DataFrame,
    stored: DataFrame,
    as_of,
    tz: str = UTC,
    ts: str = "timestamp",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows of whole days after the newest stored date and before ``as_of``.

    Without keys the newest date is a scalar subquery, read before the scan. With keys each
    has its own newest date. None stored means all days.
    """
    kind = df.schema[ts].dataType
    if keys:
        start = day_start(F.date_add(F.max("date"), 1), tz, kind)
        marks = stored.groupBy(*keys).agg(start.alias("_start"))
        end = day_start(F.lit(as_of).cast("date"), tz, kind)
        rows = df.filter(F.col(ts) < end).join(marks, list(keys), "left")
        new = F.col("_start").isNull() | (F.col(ts) >= F.col("_start"))
        return rows.filter(new).select(*df.columns)
    first_new = F.coalesce(F.date_add(F.max("date"), 1), F.lit("0001-01-01").cast("date"))
    start = stored.agg(day_start(first_new, tz, kind).alias("start")).scalar()
    end = day_start(F.lit(as_of).cast("date"), tz, kind)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def daily_summary(
    telemetry: DataFrame,
    stored: DataFrame,
    as_of,
    thresholds: Sequence[float] = THRESHOLDS,
    tz: str = UTC,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The nightly job: diary, snapshots, night charge and energy of the new days.

    Diary and snapshots share one grouping; energy needs ordered readings and is joined
    by day.
    """
    new = incremental_days(telemetry, stored, as_of, tz, keys=keys)
    days = night_charge(
        _by_day(new, keys, tz).agg(
            *diary_aggregates(new, thresholds), *snapshot_aggregates(tz=tz)
        )
    )
    energy = energy_daily(new, keys=keys, tz=tz).withColumnRenamed("kwh", "daily_solar_est")
    return days.join(energy, [*keys, "date"], "left").fillna({"daily_solar_est": 0.0})


# -- backfills ------------------------------------------------------------------------


def backfill_window(stored: DataFrame, column: str, days: int | None = None) -> DataFrame:
    """``[start, end)`` from the oldest date without ``column``; NULLs when none is left.

    ``days`` None is all later dates: the end is NULL.
    """
    last = F.date_add("start", days) if days is not None else F.lit(None).cast("date")
    return stored.filter(F.col(column).isNull()).agg(F.min("date").alias("start")).withColumn("end", last)


def _inside(df: DataFrame, column: str, window: DataFrame, edge, days: int | None) -> DataFrame:
    """Rows in the window, whose ends are read first; without ``days`` it has no upper one."""
    inside = F.col(column) >= window.select(edge("start")).scalar()
    if days is not None:
        inside = inside & (F.col(column) < window.select(edge("end")).scalar())
    return df.filter(inside)


def _days_in(stored: DataFrame, window: DataFrame, days: int | None) -> DataFrame:
    return _inside(stored, "date", window, F.col, days)


def _readings_in(telemetry: DataFrame, window: DataFrame, tz: str, days: int | None) -> DataFrame:
    kind = telemetry.schema["timestamp"].dataType
    return _inside(telemetry, "timestamp", window, lambda c: day_start(c, tz, kind), days)


def backfill_solar_estimate(
    stored: DataFrame,
    telemetry: DataFrame,
    days: int | None = None,
    tz: str = UTC,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Stored rows of the window with a new energy estimate.

    A day without one gets 0; only where the window has no readings at all the old
    value stays.
    """
    window = backfill_window(stored, "daily_solar_est", days)
    rows = _days_in(stored, window, days)
    readings = _readings_in(telemetry, window, tz, days)
    energy = energy_daily(readings, keys=keys, tz=tz)
    known = readings.filter(F.col("timestamp").isNotNull() & F.col("p_solar").isNotNull())
    has_readings = known.limit(1).agg(F.count("*") > 0).scalar()
    kept = F.when(has_readings, F.lit(0.0)).otherwise(F.coalesce("daily_solar_est", F.lit(0.0)))
    return rows.join(energy, [*keys, "date"], "left").withColumn(
        "daily_solar_est", F.coalesce("kwh", kept)
    ).select(*stored.columns)


def backfill_night_charge(
    stored: DataFrame,
    telemetry: DataFrame,
    days: int | None = None,
    tz: str = UTC,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Stored rows of the window with battery snapshots and the night charge flag."""
    window = backfill_window(stored, "night_grid_charge", days)
    rows = _days_in(stored, window, days).drop(*SNAPSHOT_NAMES, "night_grid_charge")
    snapshots = battery_snapshot(_readings_in(telemetry, window, tz, days), tz=tz, keys=keys)
    return night_charge(
        rows.join(snapshots, [*keys, "date"], "left").fillna(0.0, subset=list(SNAPSHOT_NAMES))
    )


def merge_production_log(
    summary: DataFrame, log: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """All days of both sides; a missing total comes from the log."""
    return (
        summary.join(log.select(*keys, "date", "e_day"), [*keys, "date"], "full")
        .withColumn(
            "daily_total",
            F.coalesce(F.col("daily_total").cast("double"), F.col("e_day"), F.lit(0.0)).cast("int"),
        )
        .drop("e_day")
    )
