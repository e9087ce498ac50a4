"""Keyed writes on plain Parquet: last write wins, first write wins, append.

The frame functions give the new table as a plan. The write functions touch only the
partitions that the batch has rows for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homegrid.operators.series import dedupe_first, dedupe_last

STAGING = "_staging"
BATCH = "_batch"


def _without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``other`` does not have; NULL is a key like any other."""
    known = other.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(known[f"_key_{k}"]) for k in keys])
    return df.join(known, same, "left_anti")


def keyed_replace(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``incoming``, and all of ``incoming``."""
    return _without(existing, incoming, keys).select(*existing.columns).unionByName(incoming)


def new_rows(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], arrival: str | None = None
) -> DataFrame:
    """First arrival of each key of ``incoming`` that ``existing`` does not have."""
    first = dedupe_first(incoming, keys, arrival) if arrival else incoming.dropDuplicates(list(keys))
    if existing is None:
        return first
    return _without(first, existing, keys).select(*first.columns)


def insert_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str | None = None
) -> DataFrame:
    """``existing`` and the new rows of ``incoming``; a key that is there rejects later rows."""
    return existing.unionByName(new_rows(existing, incoming, keys, arrival).select(*existing.columns))


# -- writes ---------------------------------------------------------------------------


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before the first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _touched(table: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    """Partitions of the table with rows in the batch.

    Their values, one per partition, are read first: as literals they prune the scan,
    which a join with an unfiltered batch would not.
    """
    values = [r[0] for r in batch.select(partition_col).distinct().collect()]
    hit = F.col(partition_col).isin([v for v in values if v is not None])
    if None in values:  # the overwrite replaces the partition of NULL too
        hit = hit | F.col(partition_col).isNull()
    return table.filter(hit)


def _write(
    df: DataFrame, path: str, mode: str, partition_col: str, sort_by: Sequence[str], layout: Sequence[str] | None = None
) -> None:
    """Either split of the rows gives a partition value with many rows to several tasks.

    Ranges of ``layout`` give files whose ranges do not overlap, so that the statistics in
    them rule out all but a few for one device and time; they read the rows twice.
    """
    order = [partition_col, *(layout or sort_by)]
    dealt = df.repartitionByRange(*order) if layout else df.hint("rebalance", partition_col)
    (
        dealt.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def _drop(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def finish_replace(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    partition_col: str = "date",
    layout: Sequence[str] | None = None,
) -> bool:
    """Put a complete staged version in place; True when there was one.

    A staged version that is not complete is of no use and is dropped: the table is as it
    was then.
    """
    staging = f"{path}/{STAGING}"
    complete = _exists(spark, f"{staging}/_SUCCESS")
    if complete:
        _write(spark.read.parquet(staging), path, "overwrite", partition_col, keys, layout)
    _drop(spark, staging)
    return complete


def write_keyed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str = "date",
    arrival: str | None = None,
    layout: Sequence[str] | None = None,
) -> None:
    """Keyed replace in a table partitioned by a column that follows from the key.

    The batch is computed once, into the table's folder. Of several rows with one key the
    last by ``arrival`` counts, which is not stored; without it they are an error.

    The new version of the touched partitions is staged inside the table first, where
    readers do not look, and goes from there over the old one. So no job reads the files
    that it replaces, and a driver that is lost between the two leaves the whole new
    version, which the next write puts in place. One writer per table at a time.

    ``layout``, such as device and time, clusters the files of a partition value by ranges.
    """
    spark = df.sparkSession
    finish_replace(spark, path, keys, partition_col, layout)
    table = stored(spark, path)
    rows = dedupe_last(df, keys, arrival).drop(arrival) if arrival else df
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}")
    batch = spark.read.schema(rows.schema).parquet(f"{path}/{BATCH}")
    if not arrival and not batch.groupBy(*keys).count().where("count > 1").isEmpty():
        _drop(spark, f"{path}/{BATCH}")
        raise ValueError("the batch has several rows of one key, and no arrival to choose by")
    if table is None:
        _write(batch, path, "append", partition_col, keys, layout)
    else:
        merged = keyed_replace(_touched(table, batch, partition_col), batch.select(*table.columns), keys)
        merged.write.parquet(f"{path}/{STAGING}")
        finish_replace(spark, path, keys, partition_col, layout)
    _drop(spark, f"{path}/{BATCH}")


def write_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str = "date",
    arrival: str | None = None,
    layout: Sequence[str] | None = None,
) -> None:
    """Append the rows whose key is not stored yet; writing a batch again adds nothing.

    The batch is computed once, into the table's folder, as in :func:`write_keyed`.
    """
    spark = df.sparkSession
    table = stored(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}")
    batch = spark.read.schema(df.schema).parquet(f"{path}/{BATCH}")
    known = None if table is None else _touched(table, batch, partition_col)
    _write(new_rows(known, batch, keys, arrival), path, "append", partition_col, keys, layout)
    _drop(spark, f"{path}/{BATCH}")


def append_days(
    df: DataFrame, path: str, partition_col: str = "date", keys: Sequence[str] = ()
) -> None:
    """Append summary days that are not stored yet, for each of ``keys`` on its own."""
    write_new(df, path, [*keys, partition_col], partition_col)


def with_partition_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the UTC ``date`` that tables are partitioned by."""
    return df.withColumn("date", F.to_date(ts))
