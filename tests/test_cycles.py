"""Cycles against the dense one-second algorithm on random plug series."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from homegrid.operators import cluster, cycles, devices

START = pd.Timestamp("2024-05-01 21:30:00")


def plug_series(seed, hours=60, whole=True):
    """Runs of power and of zeros, some zeros short, over a few midnights."""
    rng = np.random.default_rng(seed)
    t, rows = 0.0, []
    while t < hours * 3600:
        on = rng.random() < 0.6
        run = rng.exponential(5000 if on else 1200)
        end = t + run
        while t < end:
            t += rng.exponential(120 if on else 70) + 1
            rows.append((t, float(rng.integers(1, 2000)) if on else 0.0))
    frame = pd.DataFrame(rows, columns=["sec", "watts"])
    if whole:
        frame["sec"] = frame["sec"].round()
    frame["timestamp"] = START + pd.to_timedelta((frame["sec"] * 1e6).round(), unit="us")
    return frame.drop(columns="sec")


def dense_marks(frame):
    """Watts of every second, and the seconds at which cycles start and end, found by walking along them."""
    means = {}
    for t, w in zip(frame["timestamp"], frame["watts"]):
        means.setdefault(t.floor("s"), []).append(w)
    seconds = pd.date_range(min(means), max(means), freq="s")
    level, watts = 0.0, []
    for t in reversed(seconds):  # the next reading holds
        if t in means:
            level = sum(means[t]) / len(means[t])
        watts.append(level)
    watts.reverse()
    starts, ends = [], []
    for i in range(len(watts) - 1):
        if watts[i] == 0 and watts[i + 1] > 0:
            starts.append(seconds[i])
        elif watts[i] > 0 and watts[i + 1] == 0:
            after = watts[i + 1 : i + 301]
            if len(after) < 300 or not any(after):
                ends.append(seconds[i])
    return pd.Series(watts, seconds), starts, ends


def dense_pairs(starts, ends):
    pairs, ends = {}, np.array(ends, dtype="datetime64[us]")
    for s in starts:
        later = ends[ends > np.datetime64(s, "us")]
        if len(later):
            e = pd.Timestamp(later.min())
            if (e - s).total_seconds() > 5400 and e not in pairs:
                pairs[e] = s
    return {s: e for e, s in pairs.items()}


def to_spark(spark, frames):
    rows = [
        (dev, t.to_pydatetime(), w)
        for dev, f in enumerate(frames)
        for t, w in zip(f["timestamp"], f["watts"])
    ]
    return spark.createDataFrame(rows, "dev_id int, timestamp timestamp_ntz, watts double")


@pytest.fixture(scope="module")
def frames():
    return [plug_series(s, whole=s % 2 == 0) for s in range(8)] + [plug_series(20, hours=400)]


@pytest.fixture(scope="module")
def means(spark, frames):
    return devices.second_means(to_spark(spark, frames)).persist()


def test_marks_and_pairs(means, frames):
    marks = cycles.cycle_marks(means).persist()
    got_marks = marks.toPandas()
    got_pairs = cycles.cycle_pairs(marks).toPandas()
    assert len(got_pairs) > 20
    for dev, frame in enumerate(frames):
        _, starts, ends = dense_marks(frame)
        mine = got_marks[got_marks.dev_id == dev]
        assert sorted(mine[mine.mark == "start"].timestamp) == starts
        assert sorted(mine[mine.mark == "end"].timestamp) == ends
        pairs = got_pairs[got_pairs.dev_id == dev]
        assert dict(zip(pairs.cycle_start, pairs.cycle_end)) == dense_pairs(starts, ends)


@pytest.mark.parametrize("step", [1, 60])
def test_profiles(means, frames, step):
    pairs = cycles.cycle_pairs(cycles.cycle_marks(means))
    out = cycles.cycle_profiles(means.filter("dev_id < 4"), pairs.filter("dev_id < 4"), step).toPandas()
    checked = 0
    for dev in range(4):
        w, starts, ends = dense_marks(frames[dev])
        for s, e in dense_pairs(starts, ends).items():
            mine = out[(out.dev_id == dev) & (out.cycle_start == s)].sort_values("t")
            want = w.loc[s:e].to_numpy()[::step]
            assert list(mine.t) == list(range(0, len(want) * step, step))
            np.testing.assert_allclose(mine.watts.to_numpy(), want)
            checked += 1
    assert checked > 5


def test_null_reading_is_filled_from_the_next(spark):
    rows = [(0, 0.0), (1, 5.0), (2, None), (3, 7.0), (6000, 9.0), (6001, 0.0)]
    df = spark.createDataFrame(
        [(0, (START + pd.Timedelta(seconds=s)).to_pydatetime(), w) for s, w in rows],
        "dev_id int, timestamp timestamp_ntz, watts double",
    )
    m = devices.second_means(df)
    pairs = cycles.cycle_pairs(cycles.cycle_marks(m))
    profile = {r.t: r.watts for r in cycles.cycle_profiles(m, pairs).collect()}
    assert profile[2] == 7.0 and profile[4] == 9.0 and len(profile) == 6001


def test_device_reads(spark):
    rows = [
        (0, "2024-01-01 00:00:02", 4.0, "dishwasher"),
        (0, "2024-01-01 00:00:01", 2.0, "washer"),
        (1, "2024-01-01 00:00:01", 1.0, ""),
        (2, "2024-01-01 00:00:01", 1.0, None),
    ]
    df = spark.createDataFrame(rows, "dev_id int, timestamp string, watts double, device_location string")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert devices.device_readings(df).count() == 2
    assert devices.device_readings(df, dev_id=1).count() == 0
    assert {r.dev_id: r.device_location for r in devices.device_location(df).collect()}[0] == "washer"
    assert [(r.dev_id, r.device_location, r.n) for r in devices.device_counts(df).collect()][:2] == [
        (0, "washer", 1),
        (0, "dishwasher", 1),
    ]
    named = devices.label_devices(df, {1: "drier"}).collect()
    assert [r.device_location for r in named if r.dev_id == 1] == ["drier"]


# -- clusters -------------------------------------------------------------------------

STEPS = "dev_id int, cycle_start timestamp_ntz, lo long, hi long, watts double"


def random_cycles(spark, seed, counts):
    """Steps of random lengths and powers, and every cycle second by second."""
    rng = np.random.default_rng(seed)
    rows, dense = [], {}
    for dev, count in enumerate(counts):
        for c in range(count):
            start, at, seconds = START + pd.Timedelta(days=c, seconds=int(rng.integers(80_000))), 0, []
            for _ in range(rng.integers(1, 9)):
                length, watts = int(rng.integers(1, 30)), float(rng.integers(0, 4) * 500 * (1 + c % 3))
                rows.append((dev, start.to_pydatetime(), at, at + length - 1, watts))
                seconds += [watts] * length
                at += length
            dense[dev, start] = np.array(seconds)
    return spark.createDataFrame(rows, STEPS).repartition(5), dense


def scaled_seconds(dense):
    """Names and min-max scaled matrix of one population on a grid of seconds."""
    cycles = sorted(dense)
    matrix = np.zeros((len(cycles), max(map(len, dense.values()))))
    for row, key in zip(matrix, cycles):
        row[: len(dense[key])] = dense[key]
    low, high = matrix.min(0), matrix.max(0)
    return cycles, np.where(high > low, (matrix - low) / np.where(high > low, high - low, 1), 0)


def dense_fit(dense, k):
    """Plain k-means on seconds from the same draws: labels, squared distances, silhouettes."""
    cycles, x = scaled_seconds(dense)
    names = [f"{dev}|{start:%Y-%m-%d %H:%M:%S}" for dev, start in cycles]

    def chance(name, r):
        return -np.log((int(hashlib.md5(f"{name}|{r}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32)

    centers = [x[min(range(len(x)), key=lambda i: (chance(names[i], 0), names[i]))]]
    for r in range(1, k):
        gap = [min(((row - c) ** 2).sum() for c in centers) for row in x]
        left = [i for i in range(len(x)) if gap[i] > 1e-9]
        if left:
            centers.append(x[min(left, key=lambda i: (chance(names[i], r) / gap[i], names[i]))])
    centers = np.array(centers)
    while True:
        labels = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[labels == c].mean(0) if (labels == c).any() else centers[c] for c in range(len(centers))])
        if np.allclose(moved, centers, atol=1e-12):
            break
        centers = moved
    pairs = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i, label in enumerate(labels):
        own = labels == label
        others = [pairs[i][labels == c].mean() for c in set(labels) - {label}]
        if own.sum() < 2 or not others:
            scores.append(0.0)
        else:
            a, b = pairs[i][own].sum() / (own.sum() - 1), min(others)
            scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return {c: int(label) for c, label in zip(cycles, labels)}, ((x - centers[labels]) ** 2).sum(1), scores


def of_device(dense, dev):
    return {key: row for key, row in dense.items() if key[0] == dev}


@pytest.fixture(scope="module")
def some_cycles(spark):
    return random_cycles(spark, 8, (25, 7, 3, 1))


def test_devices_are_clustered_on_their_own(some_cycles, monkeypatch):
    """Labels are those of a fit on seconds, also where a device's rows lie in several blocks."""
    steps, dense = some_cycles
    monkeypatch.setattr(cluster, "BLOCK_BYTES", 4000)
    got = {(r.dev_id, pd.Timestamp(r.cycle_start)): r.cluster for r in cluster.cluster_devices(steps, 3).collect()}
    want = {}
    for dev in range(4):
        want |= dense_fit(of_device(dense, dev), 3)[0]
    assert got == want


def test_one_population(some_cycles):
    steps, dense = some_cycles
    got = {(r.dev_id, pd.Timestamp(r.cycle_start)): r.cluster for r in cluster.cluster_cycles(steps, 3).collect()}
    assert got == dense_fit(dense, 3)[0]


def test_sweep_and_silhouette(some_cycles):
    steps, dense = some_cycles
    costs = {(r.dev_id, r.k): r.cost for r in cluster.k_sweep(steps, (2, 3, 5)).collect()}
    scores = {(r.dev_id, r.k): r.silhouette for r in cluster.silhouettes(steps, (2, 3)).collect()}
    for dev in range(4):
        for k in (2, 3, 5):
            _, distances, own = dense_fit(of_device(dense, dev), k)
            assert costs[dev, k] == pytest.approx(distances.sum(), abs=1e-6)
            if k < 5:
                assert scores[dev, k] == pytest.approx(np.mean(own), abs=1e-6)


def test_equal_cycles_share_a_cluster(spark):
    rows = [(0, (START + pd.Timedelta(days=c)).to_pydatetime(), 0, 9, 100.0 * (c % 2)) for c in range(6)]
    labels = cluster.cluster_devices(spark.createDataFrame(rows, STEPS), 4).orderBy("cycle_start").collect()
    assert len({r.cluster for r in labels[::2]}) == len({r.cluster for r in labels[1::2]}) == 1
    assert cluster.silhouettes(spark.createDataFrame(rows, STEPS), (2,)).first().silhouette == 1.0


def test_no_cycles(spark):
    none = spark.createDataFrame([], STEPS)
    assert cluster.cluster_devices(none).count() == 0 and cluster.k_sweep(none, (2,)).count() == 0


def test_cluster_means_are_those_of_every_second(some_cycles, monkeypatch):
    steps, dense = some_cycles
    monkeypatch.setattr(cluster, "SWEEP_BUCKET", 16)
    labels = {key: hash(key[1].day) % 2 for key in dense}
    table = steps.sparkSession.createDataFrame([(d, s.to_pydatetime(), c) for (d, s), c in labels.items()], "dev_id int, cycle_start timestamp_ntz, cluster int")
    got = cluster.cluster_profiles(steps, table).toPandas()
    usage = {(r.dev_id, r.cluster): r for r in cluster.cluster_usage(steps, table).collect()}
    for dev, label in {(key[0], c) for key, c in labels.items()}:
        rows = [row for key, row in dense.items() if key[0] == dev and labels[key] == label]
        mean = np.zeros(max(map(len, rows)))
        for row in rows:
            mean[: len(row)] += row / len(rows)
        mine = got[(got.dev_id == dev) & (got.cluster == label)].sort_values("t")
        assert list(mine.t) == [0, *(mine.t_end + 1)[:-1]] and mine.t_end.iloc[-1] == len(mean) - 1
        np.testing.assert_allclose(np.repeat(mine.watts.to_numpy(), mine.t_end - mine.t + 1), mean, atol=1e-9)
        assert usage[dev, label].kwh == pytest.approx(mean.sum() / 3_600_000)
        assert usage[dev, label].kws == round(mean.sum() / 1000)
