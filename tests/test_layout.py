"""Files that are not opened, tables laid out by device and time, and joins with small tables."""

import pytest
from pyspark.sql import functions as F

from homegrid.operators import devices, joins, weather
from homegrid.sinks import keyed
from homegrid.sources import tables


def readings(spark, days=10, a_day=400):
    return spark.range(days * a_day).select(
        F.col("id"),
        (F.col("id") % 3).cast("int").alias("dev_id"),
        (F.lit("2024-03-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * (86_400 // a_day))).alias("timestamp"),
        F.lit("").alias("device_location"),
    ).withColumn("date", F.to_date("timestamp"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("newest") / "table")
    readings(spark).write.partitionBy("date").parquet(path)
    return path


@pytest.mark.parametrize("limit, days", [(5, 1), (400, 1), (401, 2), (900, 4), (3900, 10), (9000, 10)])
def test_newest_rows_open_the_newest_days(spark, table, limit, days):
    out = tables.newest_rows(spark, table, limit, columns=["id"])
    assert [r.id for r in out.collect()] == list(range(3999, max(-1, 3999 - limit), -1))
    scan = out._jdf.queryExecution().optimizedPlan().toString()
    assert scan.count(f"2024-03-{11 - days:02d}") == 1


def test_days_before_the_newest_are_not_read(spark, table, tmp_path):
    """A table whose older files are no Parquet at all is read, as long as they are not needed."""
    path = tmp_path / "table"
    readings(spark, days=3).write.partitionBy("date").parquet(str(path))
    old = path / "date=2024-03-01"
    schema = spark.read.parquet(str(path)).schema
    for file in old.glob("*.parquet"):
        file.write_bytes(b"x" * 200)
    for crc in old.glob(".*.crc"):
        crc.unlink()
    rows = spark.read.schema(schema).parquet(str(path)).filter("date >= '2024-03-03'")
    assert rows.count() == 400
    assert tables.date_bounds(spark, str(path)) == ("2024-03-01", "2024-03-03")


def test_newest_rows_that_hold_a_condition(spark, table):
    out = tables.newest_rows(spark, table, 3, where=F.col("id") < 1000)
    assert [r.id for r in out.collect()] == [999, 998, 997]
    assert tables.newest_rows(spark, table, 3, where=F.lit(False)).count() == 0


def test_bounds_come_from_names_of_folders(spark, table, tmp_path):
    assert tables.date_bounds(spark, table) == ("2024-03-01", "2024-03-10")
    (tmp_path / "date=2024-01-01").mkdir()
    assert tables.date_bounds(spark, str(tmp_path)) is None


def test_a_layout_by_device_and_time(spark, tmp_path):
    """Ranges of (device, time) do not overlap, so that a device lies in few of a day's files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = readings(spark, days=1, a_day=43_200)
        for part in (rows.filter("id % 2 = 0"), rows.withColumn("device_location", F.lit("new"))):
            keyed.write_keyed(part, str(tmp_path / "t"), ["timestamp", "dev_id"], layout=["dev_id", "timestamp"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 43_200 and table.filter("device_location = 'new'").count() == 43_200
    span = F.struct("dev_id", "timestamp")
    files = sorted(
        (r.least, r.most)
        for r in table.groupBy(F.col("_metadata.file_name")).agg(F.min(span).alias("least"), F.max(span).alias("most")).collect()
    )
    assert len(files) >= 6
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))
    assert sum(least.dev_id <= 1 <= most.dev_id for least, most in files) <= len(files) // 3 + 2


@pytest.mark.parametrize("most", [0, 100])
def test_a_large_mapping_spreads_one_device(spark, monkeypatch, most):
    """Over the threshold the rows of the one device meet the mapping in many tasks."""
    monkeypatch.setattr(joins.spread_join, "__defaults__", (most, 16))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = readings(spark).withColumn("dev_id", F.lit(1))
        named = spark.createDataFrame([(1, "drier"), (2, "oven")], "dev_id int, device_location string")
        out = devices.label_devices(df, named).withColumn("task", F.spark_partition_id())
        rows = out.groupBy("task").count().collect()
        assert out.filter("device_location = 'drier'").count() == 4000
        if most == 0:
            assert len(rows) >= 6 and max(r["count"] for r in rows) < 2000
        sun = spark.sql("select date'2024-03-01' as date, timestamp_ntz'2024-03-01 06:00' as sunrise, timestamp_ntz'2024-03-01 18:00' as sunset")
        light = weather.with_daylight(df.select(F.col("timestamp").alias("date")), sun)
        assert light.count() == 4000 and light.filter("during_day").count() == light.filter(
            "to_date(date) = '2024-03-01' and date_format(date, 'HH:mm:ss') between '06:00:00' and '18:00:00'"
        ).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_batch_is_computed_once(spark, tmp_path):
    """Every row of a batch is made once, however often the write needs it."""
    made = spark.sparkContext.accumulator(0)

    def count(row):
        made.add(1)
        return row

    rows = readings(spark, days=2, a_day=50)
    batch = spark.createDataFrame(rows.rdd.map(count), rows.schema)
    for _ in range(2):
        before = made.value
        keyed.write_new(batch, str(tmp_path / "t"), ["timestamp", "dev_id"])
        assert made.value - before == 100
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 100 and not (tmp_path / "t" / "_batch").exists()
