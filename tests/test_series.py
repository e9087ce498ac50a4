"""Bucketed operators against dense or row-by-row pandas on random series."""

import numpy as np
import pandas as pd
import pytest

from homegrid.operators import series

NIGHT = pd.Timestamp("2024-03-05 20:00:00")


def random_series(seed, rows=400, max_gap=4000, whole=False, nulls=0.0, long_gap=False):
    """Readings around several midnights, at times with gaps over days."""
    rng = np.random.default_rng(seed)
    gaps = rng.exponential(max_gap / 4, rows)
    if long_gap:
        gaps[rows // 2] = 4.5 * 86400
        gaps[rows // 3] = 2.2 * 86400
    seconds = np.cumsum(gaps + 0.5)
    if whole:
        seconds = np.unique(seconds.round())
    ts = NIGHT + pd.to_timedelta((seconds * 1e6).round(), unit="us")
    value = rng.integers(0, 5000, len(ts)).astype(float)
    value[rng.random(len(ts)) < nulls] = np.nan
    return pd.DataFrame({"timestamp": ts, "value": value})


def to_spark(spark, *frames):
    """One frame per key 0, 1, …; NaN becomes NULL."""
    rows = [
        (k, t.to_pydatetime(), None if pd.isna(v) else float(v))
        for k, f in enumerate(frames)
        for t, v in zip(f["timestamp"], f["value"])
    ]
    return spark.createDataFrame(rows, "k int, timestamp timestamp_ntz, value double")


CASES = [
    dict(seed=1),
    dict(seed=2, whole=True),
    dict(seed=3, long_gap=True),
    dict(seed=4, rows=600, max_gap=3, nulls=0.1),
    dict(seed=5, rows=3, max_gap=200_000),
]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("tz", ["UTC", "Europe/Copenhagen", "Pacific/Auckland"])
def test_energy_equals_one_second_grid(spark, case, tz):
    frame = random_series(**case)
    dense = frame.set_index("timestamp").resample("s").bfill()
    local = dense.index.tz_localize("UTC").tz_convert(tz).date
    want = (dense["value"].groupby(local).sum() / 3_600_000).to_dict()
    got = series.energy_daily(to_spark(spark, frame), "value", tz=tz).collect()
    assert {r.date: pytest.approx(r.kwh, abs=1e-9) for r in got} == want


def test_energy_over_daylight_saving_change(spark):
    frame = random_series(6, rows=500, max_gap=3000)
    frame["timestamp"] += pd.Timestamp("2024-03-30") - NIGHT
    dense = frame.set_index("timestamp").resample("s").bfill()
    local = dense.index.tz_localize("UTC").tz_convert("Europe/Copenhagen").date
    want = (dense["value"].groupby(local).sum() / 3_600_000).to_dict()
    got = series.energy_daily(to_spark(spark, frame), "value", tz="Europe/Copenhagen").collect()
    assert {r.date: pytest.approx(r.kwh, abs=1e-9) for r in got} == want


def test_energy_keeps_keys_apart(spark):
    frames = [random_series(11), random_series(12, long_gap=True)]
    both = series.energy_daily(to_spark(spark, *frames), "value", keys=["k"]).collect()
    for k, frame in enumerate(frames):
        alone = series.energy_daily(to_spark(spark, frame), "value").collect()
        assert {r.date: r.kwh for r in both if r.k == k} == pytest.approx(
            {r.date: r.kwh for r in alone}
        )


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("step", [1, 60, 900])
@pytest.mark.parametrize("skip_null", [True, False])
def test_resample_bfill(spark, case, step, skip_null):
    if step == 1 and case.get("long_gap"):
        step = 10
    frame = random_series(**case)
    known = frame.dropna() if skip_null else frame
    want = known.set_index("timestamp").resample(f"{step}s").bfill()["value"]
    got = (
        series.resample_bfill(to_spark(spark, frame), "timestamp", "value", step=step, skip_null=skip_null)
        .toPandas()
        .set_index("timestamp")["value"]
        .sort_index()
    )
    pd.testing.assert_series_equal(got, want, check_freq=False, check_index_type=False)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("step", [60, 900])
def test_resample_ffill(spark, case, step):
    frames = [random_series(**case), random_series(77, rows=50)]
    out = series.resample_ffill(to_spark(spark, *frames), "timestamp", "value", step, ["k"]).toPandas()
    for k, frame in enumerate(frames):
        want = frame.set_index("timestamp").resample(f"{step}s").ffill()["value"]
        got = out[out.k == k].set_index("timestamp")["value"].sort_index()
        pd.testing.assert_series_equal(got, want, check_freq=False, check_index_type=False)


def test_resample_ffill_on_grid_edges(spark):
    frame = pd.DataFrame(
        {
            "timestamp": pd.to_datetime(["2024-01-01 23:45", "2024-01-02 00:15", "2024-01-03 00:00"]),
            "value": [1.0, 2.0, 3.0],
        }
    )
    want = frame.set_index("timestamp").resample("15min").ffill()["value"]
    got = series.resample_ffill(to_spark(spark, frame), "timestamp", ["value"], "15 minutes")
    got = got.toPandas().set_index("timestamp")["value"].sort_index()
    pd.testing.assert_series_equal(got, want, check_freq=False, check_index_type=False)


def trailing_sums(rows, window):
    """Per row the sum over the window that it ends, None without a value; rows in order of arrival."""
    out = []
    for i, (t, _) in enumerate(rows):
        seen = [v for u, v in rows[: i + 1] if t - u < window and v is not None and np.isfinite(v)]
        out.append(sum(seen) / 4 if seen else None)
    return out


def of_key(out, k, order):
    part = out[out.k == k].sort_values(order)
    return [None if pd.isna(v) else v for v in part["rolling_sum"]]


def rows_of(frame):
    return [(t, None if pd.isna(v) else v) for t, v in zip(frame["timestamp"], frame["value"])]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize(
    "n, window, bucket",
    [(1, "3 hours", "1 day"), (4, "3 hours", "20 minutes"), (12, "3 hours", "1 day"), (2, "5 days", "1 day"), (1, "50000 seconds", "7 hours")],
)
def test_rolling_time_sum(spark, case, n, window, bucket):
    frames = [random_series(**case), random_series(78, rows=60, max_gap=60_000)]
    frames[0].loc[1, "value"] = np.inf
    out = series.rolling_time_sum(
        to_spark(spark, *frames), "timestamp", "value", window, n, keys=["k"], bucket=bucket
    ).toPandas()
    for k, frame in enumerate(frames):
        sums = trailing_sums(rows_of(frame), pd.Timedelta(window))
        want = [*sums[n - 1 :], *[None] * min(n - 1, len(sums))]
        assert of_key(out, k, "timestamp") == [None if v is None else pytest.approx(v, abs=1e-6) for v in want]


@pytest.mark.parametrize("n", [1, 2])
@pytest.mark.parametrize("bucket", ["30 minutes", "1 day"])
def test_rolling_time_sum_of_equal_times(spark, n, bucket):
    hours = [0, 1, 1, 2, 2, 2, 4, 4, 9]
    rows = [(0, (NIGHT + pd.Timedelta(hours=h)).to_pydatetime(), float(2**i), i) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "k int, timestamp timestamp_ntz, value double, arrival int").repartition(4)
    out = series.rolling_time_sum(df, "timestamp", "value", "3 hours", n, 1, ["k"], bucket=bucket, arrival="arrival")
    sums = [4 * v for v in trailing_sums([(r[1], r[2]) for r in rows], pd.Timedelta("3h"))]
    assert sums[:4] == [1, 3, 7, 15]
    assert of_key(out.toPandas(), 0, "arrival") == [*sums[n - 1 :], *[None] * (n - 1)]


@pytest.mark.parametrize("n, bucket", [(1, "1 day"), (5, "10 minutes"), (12, "1 day"), (350, "1 day"), (900, "1 day")])
def test_rolling_row_sum(spark, n, bucket):
    frames = [random_series(9, rows=800, max_gap=900, nulls=0.003, long_gap=True), random_series(79, rows=30, max_gap=90_000)]
    out = series.rolling_row_sum(to_spark(spark, *frames), "timestamp", "value", n, keys=["k"], bucket=bucket).toPandas()
    for k, frame in enumerate(frames):
        values = [v for _, v in rows_of(frame)]
        want = []
        for i in range(len(values)):
            part = values[i : i + n]
            want.append(sum(part) / 4 if len(part) == n and None not in part else None)
        assert of_key(out, k, "timestamp") == [None if v is None else pytest.approx(v, abs=1e-6) for v in want]


@pytest.mark.parametrize("operator", ["time", "rows"])
def test_rolling_work_does_not_grow_with_the_window(spark, operator):
    """Rows shuffled: the same for twelve rows or hours as for thousands."""
    df = to_spark(spark, random_series(31, rows=3000, max_gap=200))

    def shuffled(size):
        if operator == "rows":
            out = series.rolling_row_sum(df, "timestamp", "value", size)
        else:
            out = series.rolling_time_sum(df, "timestamp", "value", f"{size} hours", 2)
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Expand" not in text and "collect_list" not in text
        return text.count("Exchange"), text.count("Generate")

    assert shuffled(12) == shuffled(720)


@pytest.mark.parametrize("case", CASES)
def test_sampling_step(spark, case):
    frame = random_series(**case)
    step = frame["timestamp"].diff().median()
    row = series.sampling_step(to_spark(spark, frame), "timestamp").first()
    assert row.step_us == pytest.approx(step / pd.Timedelta("1us"), abs=1)
    assert row.rows_in_window == int(pd.Timedelta("3h") / step)


def test_median_of_few_bins(spark, monkeypatch):
    """Ranges shrink over several rounds to the same two middle steps."""
    monkeypatch.setattr(series, "BINS", 3)
    frames = [random_series(s, rows=rows) for s, rows in ((41, 50), (42, 51), (43, 2), (44, 1))]
    got = {r.k: r.step_us for r in series.sampling_step(to_spark(spark, *frames), "timestamp", keys=["k"]).collect()}
    want = {k: f["timestamp"].diff().dropna().dt.total_seconds().median() * 1e6 for k, f in enumerate(frames[:3])}
    assert got == pytest.approx(want)
    none = series.sampling_step(to_spark(spark, frames[3]), "timestamp").collect()
    assert [tuple(r) for r in none] == [(None, None)]


def test_dedupe_keeps_last_and_first(spark):
    rows = [("a", 1, 10.0), ("a", 3, None), ("a", 2, 20.0), ("b", 4, 5.0)]
    df = spark.createDataFrame(rows, "k string, arrival int, v double")
    last = {r.k: (r.arrival, r.v) for r in series.dedupe_last(df, ["k"], "arrival").collect()}
    first = {r.k: (r.arrival, r.v) for r in series.dedupe_first(df, ["k"], "arrival").collect()}
    assert last == {"a": (3, None), "b": (4, 5.0)}
    assert first == {"a": (1, 10.0), "b": (4, 5.0)}


def test_dst_repair(spark):
    stamps = ["2023-10-29 00:00", "2023-10-29 01:00", "2023-10-29 01:00", "2023-10-29 02:00"]
    frame = pd.DataFrame({"timestamp": pd.to_datetime(stamps), "value": [1.0, 2.0, 3.0, 4.0]})
    index = pd.DatetimeIndex(frame["timestamp"])
    want = index.where(~index.duplicated(keep="last"), index - pd.Timedelta("1h"))
    out = series.dst_repair(to_spark(spark, frame), "timestamp", "value").orderBy("value").toPandas()
    assert list(out["timestamp"]) == list(want)


def test_hot_second_is_one_row(spark):
    """A third of all rows in one second do not change the energy."""
    frame = random_series(21, whole=True)
    hot = pd.DataFrame(
        {
            "timestamp": frame["timestamp"].iloc[10] + pd.to_timedelta(range(1, 300), unit="ms"),
            "value": 9999.0,
        }
    )
    both = pd.concat([frame, hot])
    dense = both.sort_values("timestamp").set_index("timestamp").resample("s").bfill()
    want = (dense["value"].groupby(dense.index.date).sum() / 3_600_000).to_dict()
    got = series.energy_daily(to_spark(spark, both), "value").collect()
    assert {r.date: pytest.approx(r.kwh, abs=1e-9) for r in got} == want
