"""Appliance cycles: marks, pairs and profiles.

Input are the per-second means of :func:`homegrid.operators.devices.second_means`, with
watts >= 0. All windows are over (key, day) with what other days say carried over, so one
busy device spreads over as many tasks as it has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homegrid.functions.clock import DAY, epoch_seconds, floor_div, from_seconds
from homegrid.operators.series import BUCKET, bucket_of, explode_range, in_buckets, with_neighbours

DEVICE = ("dev_id",)
QUIET_SECONDS = 300
MIN_CYCLE_SECONDS = 5400


def _per_second(means: DataFrame, keys: Sequence[str]) -> DataFrame:
    sec = epoch_seconds("timestamp")
    rows = means.filter(F.col("watts").isNotNull()).select(*keys, sec.alias("_sec"), "watts")
    return in_buckets(rows, F.col("_sec"), keys)


def cycle_marks(
    means: DataFrame, quiet_s: int = QUIET_SECONDS, keys: Sequence[str] = DEVICE
) -> DataFrame:
    """Starts and ends of cycles.

    A start is a zero before a positive reading. An end is a positive reading before a
    zero that stays zero for ``quiet_s`` seconds, or with fewer than that left in the
    series. Between readings the next one holds, so the quiet time ends at the last zero
    before the next positive reading.
    """
    keys = list(keys)
    day = Window.partitionBy(*keys, BUCKET).orderBy("_sec")
    rows = _per_second(means, keys).withColumns(
        {
            "_prev_sec": F.lag("_sec").over(day),
            "_prev_watts": F.lag("watts").over(day),
            "_next_watts": F.lead("watts").over(day),
        }
    )
    on, off = F.col("watts") > 0, F.col("watts") == 0
    # Rows next to a change, and the edges of the day, say all there is to know.
    edges = rows.filter(
        F.col("_prev_sec").isNull()
        | F.col("_next_watts").isNull()
        | (on & ((F.col("_prev_watts") == 0) | (F.col("_next_watts") == 0)))
        | (off & (F.col("_next_watts") > 0))
    )

    per_day = edges.groupBy(*keys, BUCKET).agg(
        F.min_by("watts", "_sec").alias("_first_watts"),
        F.max("_sec").alias("_last_sec"),
        F.min(F.when(on, F.col("_sec"))).alias("_on_sec"),
        F.min_by("_prev_sec", F.when(on, F.col("_sec"))).alias("_before_on"),
    )
    days = Window.partitionBy(*keys).orderBy(BUCKET)
    back = Window.partitionBy(*keys).orderBy(F.desc(BUCKET))
    carry = (
        per_day.withColumn("_day_before", F.lag("_last_sec").over(days))
        .withColumn(
            "_zero_until",
            F.when(F.col("_on_sec").isNotNull(), F.coalesce("_before_on", "_day_before")),
        )
        .select(
            *keys,
            BUCKET,
            F.lead("_first_watts").over(days).alias("_next_day_watts"),
            F.last("_zero_until", ignorenulls=True)
            .over(back.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_zero_until_later"),
            F.max("_last_sec").over(Window.partitionBy(*keys)).alias("_series_end"),
        )
    )

    # Descending order makes "the next positive row" a running value.
    later = (
        Window.partitionBy(*keys, BUCKET)
        .orderBy(F.desc("_sec"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = (
        edges.withColumn(
            "_zero_until", F.last(F.when(on, F.col("_prev_sec")), ignorenulls=True).over(later)
        )
        .join(carry, [*keys, BUCKET], "left")
        .withColumn("_next_watts", F.coalesce("_next_watts", "_next_day_watts"))
        .withColumn("_zero_until", F.coalesce("_zero_until", "_zero_until_later", "_series_end"))
    )
    quiet = (F.col("_series_end") - F.col("_sec") < quiet_s) | (
        F.col("_zero_until") - F.col("_sec") >= quiet_s
    )
    kind = F.when(off & (F.col("_next_watts") > 0), "start").when(
        on & (F.col("_next_watts") == 0) & quiet, "end"
    )
    return (
        marked.withColumn("mark", kind)
        .filter(F.col("mark").isNotNull())
        .select(*keys, from_seconds("_sec").alias("timestamp"), "mark")
    )


def cycle_pairs(
    marks: DataFrame, min_s: int = MIN_CYCLE_SECONDS, keys: Sequence[str] = DEVICE
) -> DataFrame:
    """Each end with its earliest start after the end before, when over ``min_s`` long.

    Starts are first reduced to one per end within their day. That leaves at most one row
    per quiet period, so the look-ahead over days is over few rows per device.
    """
    keys = list(keys)
    sec = epoch_seconds("timestamp")
    rows = marks.select(*keys, sec.alias("_sec"), "mark", bucket_of(sec).alias(BUCKET))
    ahead = (
        Window.partitionBy(*keys, BUCKET)
        .orderBy(F.desc("_sec"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    end_sec = F.when(F.col("mark") == "end", F.col("_sec"))
    reduced = (
        rows.withColumn("_end", F.min(end_sec).over(ahead))
        .groupBy(*keys, BUCKET, "_end")
        .agg(F.min(F.when(F.col("mark") == "start", F.col("_sec"))).alias("_start"))
    )
    later_days = (
        Window.partitionBy(*keys)
        .orderBy(F.desc(BUCKET))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    resolved = reduced.withColumn(
        "_end", F.coalesce(F.col("_end"), F.min("_end").over(later_days))
    ).filter("_end is not null and _start is not null")
    return (
        resolved.groupBy(*keys, "_end")
        .agg(F.min("_start").alias("_start"))
        .filter(F.col("_end") - F.col("_start") > min_s)
        .select(
            *keys,
            from_seconds("_start").alias("cycle_start"),
            from_seconds("_end").alias("cycle_end"),
            (F.col("_end") - F.col("_start")).alias("seconds"),
        )
    )


def with_cycle_label(pairs: DataFrame) -> DataFrame:
    """Name of a cycle, by its start to the minute."""
    return pairs.withColumn("label", F.date_format("cycle_start", "yyyy-MM-dd HH:mm"))


def cycle_span(pairs: DataFrame, keys: Sequence[str] = DEVICE) -> DataFrame:
    """Dates of the first and last cycle, as in the title of a plot."""
    return pairs.groupBy(*keys).agg(
        F.date_format(F.min("cycle_start"), "yy-MM-dd").alias("first_day"),
        F.date_format(F.max("cycle_start"), "yy-MM-dd").alias("last_day"),
        F.count("*").alias("cycles"),
    )


def with_minutes(profiles: DataFrame) -> DataFrame:
    """Elapsed minutes, the scale on which profiles are shown."""
    return profiles.withColumn("minutes", F.col("t") / 60)


def cycle_steps(means: DataFrame, pairs: DataFrame, keys: Sequence[str] = DEVICE) -> DataFrame:
    """Watts of each cycle as a step function: seconds ``lo``..``hi`` (inclusive) since its start.

    A reading holds for the seconds since the one before it, so the steps of a cycle say what a grid
    of seconds would, in one row per reading. Readings meet cycles by (key, day) and time range;
    cycles of a device do not overlap.
    """
    keys = list(keys)
    readings = with_neighbours(_per_second(means, keys), "_sec", keys, prev="_prev")
    cycles = pairs.select(
        *keys,
        "cycle_start",
        epoch_seconds("cycle_start").alias("_start"),
        epoch_seconds("cycle_end").alias("_end"),
    ).withColumn(
        BUCKET,
        F.explode(F.sequence(floor_div(F.col("_start"), DAY), floor_div(F.col("_end"), DAY))),
    )
    inside = readings.join(cycles, [*keys, BUCKET]).filter("_sec between _start and _end")
    # the start is itself a reading, so the one before any later reading is in the cycle
    since = F.when(F.col("_sec") == F.col("_start"), F.lit(0)).otherwise(
        F.col("_prev._sec") + 1 - F.col("_start")
    )
    return inside.select(
        *keys, "cycle_start", since.alias("lo"), (F.col("_sec") - F.col("_start")).alias("hi"), "watts"
    )


def profile_grid(steps: DataFrame, step_s: int = 1) -> DataFrame:
    """Step functions on a regular grid: one row every ``step_s`` seconds, in column ``t``."""
    others = [c for c in steps.columns if c not in ("lo", "hi", "watts")]
    cells = steps.select(
        *others,
        "watts",
        floor_div(F.col("lo") + F.lit(step_s - 1), step_s).alias("_lo"),
        floor_div(F.col("hi"), step_s).alias("_hi"),
    ).filter("_lo <= _hi")
    return explode_range(cells, "_lo", "_hi", "_step").select(
        *others, (F.col("_step") * step_s).alias("t"), "watts"
    )


def cycle_profiles(
    means: DataFrame, pairs: DataFrame, step_s: int = 1, keys: Sequence[str] = DEVICE
) -> DataFrame:
    """Watts by elapsed seconds ``t`` of each cycle, every ``step_s`` seconds."""
    return profile_grid(cycle_steps(means, pairs, keys), step_s)
