"""Day-ahead prices: union, cleaning, tariffs and the price view of the dashboard."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homegrid.functions.clock import UTC, epoch_seconds, local_wall
from homegrid.functions.energy import CHEAP_BELOW, finite, tariff_offset
from homegrid.operators.series import BUCKET, in_buckets, with_row_numbers

PRICE_LIMIT = 100


def union_prices(*frames: DataFrame | None, arrival: str | None = None) -> DataFrame:
    """Distinct rows of all fetches; one that is not there yet is left out.

    Rows that differ in ``arrival`` only are one row, with the first arrival.
    """
    rows = reduce(DataFrame.unionByName, [f for f in frames if f is not None])
    if arrival is None:
        return rows.dropDuplicates()
    same = [c for c in rows.columns if c != arrival]
    return rows.groupBy(*same).agg(F.min(arrival).alias(arrival))


def clean_prices(df: DataFrame, value: str = "price") -> DataFrame:
    """Drop rows whose price is NULL, NaN or infinite."""
    return df.withColumn(value, finite(value)).dropna(subset=[value])


def with_tariff(
    prices: DataFrame, tz: str | None = None, cheap_below: float = CHEAP_BELOW
) -> DataFrame:
    """Add the tariff, the price with it, and whether that is below the cheap line."""
    return (
        prices.withColumn("offset", tariff_offset("timestamp", tz))
        .withColumn("price_with_tariff", F.col("price") + F.col("offset"))
        .withColumn("is_cheap", F.col("price_with_tariff") < cheap_below)
    )


def price_view(
    prices: DataFrame,
    base,
    limit: int | None = PRICE_LIMIT,
    as_of=None,
    tz: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The first ``limit`` prices from ``base``, or all of them, with tariff and local time.

    ``row_index`` counts these rows before ``as_of`` drops those over an hour old. Without a limit
    the rows are counted by day. With ``keys``, such as the price area, each has its own.
    """
    kind = prices.schema["timestamp"].dataType
    later = prices.filter(F.col("timestamp") >= F.lit(base).cast(kind))
    order = Window.partitionBy(*keys).orderBy("timestamp")
    if limit is None:
        days = in_buckets(later, epoch_seconds("timestamp"), keys)
        top = with_row_numbers(days, ["timestamp"], keys, "row_index").drop(BUCKET)
    elif keys:
        top = later.withColumn("row_index", F.row_number().over(order) - 1).filter(F.col("row_index") < limit)
    else:
        top = later.orderBy("timestamp").limit(limit)
        top = top.withColumn("row_index", F.row_number().over(order) - 1)
    view = with_tariff(top, tz)
    if as_of is not None:
        oldest = F.lit(as_of).cast(kind) - F.expr("interval 1 hour")
        view = view.filter(F.col("timestamp") > oldest)
    wall = local_wall("timestamp", tz or UTC)
    return view.withColumn("timestamp", wall).withColumn("hour", F.hour("timestamp"))


def price_span(view: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Axis label ``"d"`` or ``"d1 to d2"`` and the currency of the first row."""
    first, last = F.to_date(F.min("timestamp")), F.to_date(F.max("timestamp"))
    label = F.when(first == last, first.cast("string")).otherwise(
        F.concat(first.cast("string"), F.lit(" to "), last.cast("string"))
    )
    return view.groupBy(*keys).agg(label.alias("label"), F.min_by("currency", "timestamp").alias("currency"))


def first_midnight(view: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First row at hour 0 other than the very first row of the view."""
    at_midnight = (F.col("hour") == 0) & (F.col("row_index") != 0)
    return view.groupBy(*keys).agg(F.min(F.when(at_midnight, F.col("timestamp"))).alias("midnight"))
