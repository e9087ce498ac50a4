"""Keyed writes, stored precision and streams on files."""

import json

import pytest
from pyspark.sql import functions as F

from homegrid import schemas
from homegrid.operators import daily
from homegrid.plans import views
from homegrid.sinks import keyed, typed
from homegrid.sources import payloads, tables
from homegrid.streaming import ingest
from tests.test_payloads import power_flow


def frame(spark, rows):
    df = spark.createDataFrame(rows, "timestamp string, dev_id int, watts double")
    return keyed.with_partition_date(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))


def content(df):
    return sorted((str(r.timestamp), r.dev_id, r.watts) for r in df.collect())


FIRST = [("2024-01-01 10:00:00", 0, 1.0), ("2024-01-01 10:00:00", 1, 2.0), ("2024-01-02 10:00:00", 0, 3.0)]
SECOND = [("2024-01-01 10:00:00", 0, 9.0), ("2024-01-03 10:00:00", 0, 4.0)]
KEYS = ["timestamp", "dev_id"]


def test_write_keyed(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(frame(spark, FIRST), path, KEYS)
    untouched = sorted(p.name for p in (tmp_path / "t" / "date=2024-01-02").iterdir())
    for _ in range(2):
        keyed.write_keyed(frame(spark, SECOND), path, KEYS)
        assert content(spark.read.parquet(path)) == sorted([SECOND[0], FIRST[1], FIRST[2], SECOND[1]])
    assert untouched == sorted(p.name for p in (tmp_path / "t" / "date=2024-01-02").iterdir())


def test_lost_driver_between_staging_and_replace(spark, tmp_path):
    """The partition is gone, its staged version is whole: the next write restores it."""
    path = str(tmp_path / "t")
    keyed.write_keyed(frame(spark, FIRST), path, KEYS)
    day_one = [SECOND[0], FIRST[1]]
    frame(spark, day_one).write.parquet(f"{path}/{keyed.STAGING}")
    for file in (tmp_path / "t" / "date=2024-01-01").iterdir():
        file.unlink()
    keyed.write_keyed(frame(spark, [SECOND[1]]), path, KEYS)
    assert content(spark.read.parquet(path)) == sorted([*day_one, FIRST[2], SECOND[1]])
    assert not (tmp_path / "t" / keyed.STAGING).exists()


def test_incomplete_staging_is_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(frame(spark, FIRST), path, KEYS)
    frame(spark, SECOND).write.parquet(f"{path}/{keyed.STAGING}")
    (tmp_path / "t" / keyed.STAGING / "_SUCCESS").unlink()
    assert not keyed.finish_replace(spark, path, KEYS)
    assert content(spark.read.parquet(path)) == sorted(FIRST)


def test_keyed_replace_twice_is_once(spark):
    a, b = frame(spark, FIRST), frame(spark, SECOND)
    once = keyed.keyed_replace(a, b, KEYS)
    assert content(keyed.keyed_replace(once, b, KEYS)) == content(once)
    by_time = keyed.keyed_replace(a, b, ["timestamp"])
    assert content(by_time) == sorted([SECOND[0], FIRST[2], SECOND[1]])


def test_write_new_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        keyed.write_new(frame(spark, FIRST), path, KEYS)
        keyed.write_new(frame(spark, SECOND), path, KEYS)
    assert content(spark.read.parquet(path)) == sorted([*FIRST, SECOND[1]])
    part = tables.read_table(spark, str(tmp_path), "t", "2024-01-02", "2024-01-04", ["timestamp", "watts"], sort=True)
    assert [r.watts for r in part.collect()] == [3.0, 4.0]
    assert "PartitionFilters: [isnotnull(date" in part._jdf.queryExecution().toString()


def test_a_batch_reads_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_new(frame(spark, FIRST), path, KEYS)
    part = keyed._touched(keyed.stored(spark, path), frame(spark, [FIRST[2]]), "date")
    assert "PartitionFilters: [isnotnull(date" in part._jdf.queryExecution().toString()
    assert [p for f in part.inputFiles() for p in f.split("/") if p.startswith("date=")] and all(
        "date=2024-01-02" in r[0] for r in part.select(F.input_file_name()).collect()
    )
    assert part.count() == 1


def test_a_null_date_in_the_batch_loses_no_stored_row(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "dev_id int, date date"
    keyed.write_keyed(spark.createDataFrame([(1, None), (2, None)], schema), path, ["dev_id"])
    keyed.write_keyed(spark.createDataFrame([(3, None)], schema), path, ["dev_id"])
    assert sorted(r.dev_id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_a_repeated_key_needs_an_arrival(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 5, 0), (1, 6, 1)], "k int, v int, arrival int").withColumn("date", F.current_date())
    with pytest.raises(ValueError):
        keyed.write_keyed(rows.drop("arrival"), path, ["k"])
    keyed.write_keyed(rows, path, ["k"], arrival="arrival")
    assert [r.v for r in spark.read.parquet(path).collect()] == [6]


def test_append_days_of_two_sites(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.sql("select 'a' as site_id, date'2024-01-01' as date union all select 'b', date'2024-01-01'")
    keyed.append_days(rows, path, keys=["site_id"])
    keyed.append_days(rows, path, keys=["site_id"])
    assert sorted(r.site_id for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_the_last_row_needs_an_arrival(spark, tmp_path):
    with pytest.raises(ValueError):
        ingest.stream_ingest(None, None, str(tmp_path / "s"), str(tmp_path / "c"), KEYS, replace=True)


def test_append_days(spark, tmp_path, events):
    path = str(tmp_path / "days")
    days = daily.day_summary(views.telemetry(events))
    keyed.append_days(days.filter("date < date'2024-01-20'"), path)
    keyed.append_days(days, path)
    assert spark.read.parquet(path).count() == days.count() == 30


def test_conform(spark):
    df = spark.sql("select timestamp'2024-01-01' as timestamp, 12.345 as price, 1e9D as rolling_sum, 'DKK' as currency")
    assert str(typed.conform(df.drop("rolling_sum"), "price_data").first().price) == "12.35"
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        typed.conform(df, "price_data").collect()
    assert typed.conform(df, "price_data", "null").first().rolling_sum is None
    assert typed.conform_rejects(df, "price_data").count() == 1
    long = df.withColumn("currency", F.lit("KRONER")).drop("rolling_sum")
    with pytest.raises(Exception, match="over 3 long"):
        typed.conform(long, "price_data").collect()
    assert typed.conform_rejects(long, "price_data").count() == 1
    assert typed.conform_rejects(df.drop("rolling_sum"), "price_data").count() == 0


@pytest.mark.parametrize("name", list(schemas.TABLES))
def test_conform_knows_every_table(spark, name):
    out = typed.conform(spark.range(1).drop("id"), name)
    assert out.columns == schemas.table_schema(name).fieldNames() and out.count() == 1


# -- streams --------------------------------------------------------------------------


def drop_file(folder, name, payload_list):
    (folder / name).write_text("\n".join(json.dumps(p) if isinstance(p, dict) else p for p in payload_list))


def test_stream_ingest_restarts(spark, tmp_path):
    src, sink, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    src.mkdir()

    def run():
        bodies = ingest.payload_stream(spark, str(src), files_per_batch=1)
        ingest.stream_ingest(bodies, payloads.parse_power_flow, sink, check).awaitTermination()
        return sorted((str(r.timestamp), r.p_solar) for r in spark.read.parquet(sink).collect())

    stamp = "2021-03-01T18:31:{:02d}+01:00".format
    drop_file(src, "a", [power_flow(stamp(1), pv=1), power_flow(stamp(2), pv=2), "{oops"])
    first = run()
    assert first == [("2021-03-01 17:31:01", 1), ("2021-03-01 17:31:02", 2)]
    assert run() == first
    drop_file(src, "b", [power_flow(stamp(2), pv=99), power_flow(stamp(3), pv=3)])
    assert run() == [*first, ("2021-03-01 17:31:03", 3)]
    # the same payloads again, without the checkpoint
    bodies = ingest.payload_stream(spark, str(src))
    ingest.stream_ingest(bodies, payloads.parse_power_flow, sink, check + "2").awaitTermination()
    assert spark.read.parquet(sink).count() == 3


def test_stream_ingest_of_plugs_keeps_the_last(spark, tmp_path):
    src, sink = tmp_path / "in", str(tmp_path / "table")
    src.mkdir()

    def plug(watts, t=1704067200, dev=0):
        return {"update": {"dps": {"19": watts * 10}, "t": t}, "dev_id": dev, "device_id": "x"}

    drop_file(src, "a", [plug(1), plug(5, dev=1)])
    for name, batch in (("a", None), ("b", [plug(7), plug(8, t=1704067201)])):
        if batch:
            drop_file(src, name, batch)
        bodies = ingest.payload_stream(spark, str(src))
        ingest.stream_ingest(
            bodies.withColumn("arrival", F.lit(0)),
            lambda df: payloads.parse_plug_status(df, keep=["arrival"]),
            sink,
            str(tmp_path / "check"),
            KEYS,
            arrival="arrival",
            replace=True,
        ).awaitTermination()
    assert sorted(r.watts for r in spark.read.parquet(sink).collect()) == [5, 7, 8]


def test_stream_day_summary_modes(spark, tmp_path, events):
    """Update mode gives every day; append mode only those the watermark has passed."""
    src = tmp_path / "events"
    rows = events.withColumn("third", F.floor(F.dayofmonth("ts") / 11))
    for third in range(3):
        rows.filter(F.col("third") == third).drop("third").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    telemetry = views.telemetry(stream).withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    days = ingest.stream_day_summary(telemetry)
    ingest.start_day_summary(days, str(tmp_path / "days"), str(tmp_path / "c1")).awaitTermination()
    batch = {r.date: r.peak_solar for r in daily.day_summary(views.telemetry(events)).collect()}
    assert {r.date: r.peak_solar for r in spark.read.parquet(str(tmp_path / "days")).collect()} == batch

    closed = (
        ingest.stream_day_summary(telemetry)
        .writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "closed"))
        .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    )
    closed.awaitTermination()
    got = {r.date: r.peak_solar for r in spark.read.parquet(str(tmp_path / "closed")).collect()}
    assert 20 < len(got) < 30 and all(batch[d] == p for d, p in got.items())


def test_stream_dedupe(spark, tmp_path, events):
    src = str(tmp_path / "events")
    events.union(events).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    rows = stream.select(F.col("ts").cast("timestamp").alias("timestamp"), "event_id")
    out = ingest.stream_dedupe(rows, ["event_id"])
    out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()
