"""Table scans, the production log and date spines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homegrid import schemas


def read_table(
    spark: SparkSession,
    base: str,
    name: str,
    start=None,
    end=None,
    columns: Sequence[str] | None = None,
    ts: str = "timestamp",
    sort: bool = False,
) -> DataFrame:
    """Columns of a table in the half-open range ``[start, end)`` of its time column.

    Range and columns reach the Parquet scan. A table partitioned by ``date`` is also
    pruned to the dates of the range.
    """
    df = spark.read.parquet(f"{base}/{name}")
    kind = df.schema[ts].dataType
    by_date = "date" in df.columns and ts != "date"
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
        if by_date:
            df = df.filter(F.col("date") >= F.lit(start).cast("timestamp").cast("date"))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end).cast(kind))
        if by_date:
            df = df.filter(F.col("date") <= F.lit(end).cast("timestamp").cast("date"))
    if columns:
        df = df.select(*columns)
    return df.orderBy(ts) if sort else df


def partition_values(spark: SparkSession, path: str, partition_col: str = "date") -> list[str]:
    """Values of the partitions that have files, in order, from the folder names: one per day."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = f"{partition_col}="
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name != f"{prefix}__HIVE_DEFAULT_PARTITION__":
            files = [f.getPath().getName() for f in fs.listStatus(status.getPath())]
            if any(f.endswith(".parquet") and not f.startswith(("_", ".")) for f in files):
                found.append(name.removeprefix(prefix))
    return sorted(found)


def date_bounds(spark: SparkSession, path: str, partition_col: str = "date") -> tuple[str, str] | None:
    """Oldest and newest date of a table partitioned by date, without opening a file of it."""
    values = partition_values(spark, path, partition_col)
    return (values[0], values[-1]) if values else None


def newest_rows(
    spark: SparkSession,
    path: str,
    limit: int,
    ts: str = "timestamp",
    columns: Sequence[str] | None = None,
    partition_col: str = "date",
    where: Column | None = None,
) -> DataFrame:
    """The ``limit`` newest rows of a table partitioned by the UTC date of ``ts``, newest first.

    Days are opened from the newest back, twice as many each time, until they have enough rows
    (that hold ``where``); older days are never opened.
    """
    table = spark.read.parquet(path)
    days = partition_values(spark, path, partition_col)
    taken, rows = 0, table.limit(0)
    while taken < len(days):
        taken = min(max(1, 2 * taken), len(days))
        rows = table.filter(F.col(partition_col).cast("string") >= days[-taken])
        if where is not None:
            rows = rows.filter(where)
        if rows.select(ts).limit(limit).count() >= limit:
            break
    if columns:
        rows = rows.select(*columns)
    return rows.orderBy(F.desc(ts)).limit(limit)


def new_log_days(log: DataFrame, as_of, after: DataFrame | None = None) -> DataFrame:
    """Log days before ``as_of`` and after the newest date of ``after``."""
    days = log.filter(F.col("date") <= F.date_sub(F.lit(as_of).cast("date"), 1))
    if after is None:
        return days
    newest = after.agg(F.coalesce(F.max("date"), F.lit("0001-01-01").cast("date")).alias("d"))
    return days.filter(F.col("date") > newest.scalar())


def read_production_log(
    spark: SparkSession, path: str, as_of, after: DataFrame | None = None, format: str = "csv"
) -> DataFrame:
    """Production log (date, total_wh), as date and e_day, of the days not stored yet."""
    reader = spark.read.schema(schemas.PRODUCTION_LOG)
    log = reader.csv(path, header=True) if format == "csv" else reader.format(format).load(path)
    return new_log_days(log.withColumnRenamed("total_wh", "e_day"), as_of, after)


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """Every date in ``[start, end]``."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
        ).alias("date")
    )


def recent_dates(spark: SparkSession, today, days: int) -> DataFrame:
    """``today`` and the days before it, ``days`` in all."""
    return date_spine(spark, F.date_sub(F.lit(today).cast("date"), days - 1), today)


def spine_of(df: DataFrame, day: str = "date") -> DataFrame:
    """Every date from the first to the last date of ``df``."""
    ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).filter("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))


def missing_dates(spine: DataFrame, stored: DataFrame, key: str = "date") -> DataFrame:
    """Dates of the spine before the oldest stored one."""
    oldest = stored.agg(F.coalesce(F.min(key), F.lit("9999-12-31").cast("date")).alias("d"))
    return spine.filter(F.col("date") < oldest.scalar())
