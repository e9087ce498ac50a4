"""Clusters of cycle profiles, exact to the second, on step functions.

A profile is a step function: ``lo``..``hi`` (elapsed seconds, inclusive) has ``watts``, as
:func:`homegrid.operators.cycles.cycle_steps` gives it. The seconds at which any cycle of a
population changes cut time into segments, on each of which all its cycles are constant. Min-max
scaled per second and weighted by the root of the segment's length, a cycle is one number a
segment, and the squared distance of two such rows is that of their profiles second by second.
A cycle that has ended counts as 0 watts.

A population is given by ``by``: each device on its own (the default), or all cycles with ``()``.
All populations and all ``k`` are fitted in the same jobs. The rows of a population lie in blocks
of bounded size, which stay where they are from round to round while the centers come to them.

First centers follow the squared distance to the nearest center so far: with u from a hash of the
cycle and the round, the cycle with the smallest -ln(u) / distance is drawn with a chance in
proportion to its distance, and is the same one in each run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from homegrid.functions.clock import floor_div
from homegrid.session import stored_copy

DEVICE = ("dev_id",)
ROUNDS = 300
SAME = 1e-9
WATT_SECONDS_PER_KWH = 3_600_000
#: Bytes of scaled rows in a block, about.
BLOCK_BYTES = 32 << 20
#: Digits of watts that sums of differences keep exact.
EXACT = "decimal(28,9)"
SWEEP_BUCKET = 16_384


# -- rows of numbers ------------------------------------------------------------------


def _segments(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Seconds where a population changes, numbered, with the length of the segment that follows.

    There are at most as many as its longest cycle has seconds.
    """
    edges = steps.select(*by, F.col("lo").alias("edge")).unionByName(steps.select(*by, (F.col("hi") + 1).alias("edge")))
    order = Window.partitionBy(*by).orderBy("edge")
    return edges.distinct().select(
        *by, "edge", (F.row_number().over(order) - 1).alias("_at"), (F.lead("edge").over(order) - F.col("edge")).alias("_length")
    )


def _rows(steps: DataFrame, by: Sequence[str], cycle: Sequence[str]) -> DataFrame:
    """One scaled, weighted array per cycle, as long as its population has segments."""
    segments = stored_copy(_segments(steps, by), "segments")
    start = segments.select(*by, F.col("edge").alias("lo"), F.col("_at").alias("_from"))
    end = segments.select(*by, (F.col("edge") - 1).alias("hi"), F.col("_at").alias("_to"))
    runs = F.sort_array(F.collect_list(F.struct("_from", "_to", "watts")))
    flat = F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["watts"], (r["_to"] - r["_from"]).cast("int"))))
    cycles = (
        steps.join(start, [*by, "lo"]).join(end, [*by, "hi"]).groupBy(*cycle).agg(runs.alias("_runs"))
        .select(*cycle, flat.alias("_watts"))
    )
    lengths = F.sort_array(F.collect_list(F.struct("_at", "_length")))["_length"]
    per_population = segments.filter("_length is not null").groupBy(*by).agg(lengths.alias("_lengths"))
    padded = F.concat("_watts", F.array_repeat(F.lit(0.0), F.size("_lengths") - F.size("_watts")))
    whole = stored_copy(cycles.join(per_population, list(by)).select(*cycle, padded.alias("_watts")), "watts")
    ranges = (
        whole.groupBy(*by)
        .agg(Summarizer.metrics("min", "max", "count").summary(array_to_vector("_watts")).alias("s"))
        .select(*by, vector_to_array("s.min").alias("_least"), vector_to_array("s.max").alias("_most"), F.col("s.count").alias("_cycles"))
    )
    gain = F.transform(
        F.arrays_zip("_least", "_most", "_lengths"),
        lambda z: F.when(z["_most"] > z["_least"], F.sqrt(z["_lengths"]) / (z["_most"] - z["_least"])).otherwise(0.0),
    )
    n_blocks = F.ceil(F.col("_cycles") * F.size("_lengths") * 8 / F.lit(BLOCK_BYTES))
    scales = ranges.join(per_population, list(by)).select(*by, "_least", gain.alias("_gain"), n_blocks.alias("_blocks"))
    x = F.zip_with(F.zip_with("_watts", "_least", lambda a, b: a - b), "_gain", lambda a, g: a * g)
    name = F.concat_ws("|", *[_text(whole, c) for c in cycle if c != "_all"])
    block = F.pmod(F.xxhash64(*cycle), F.col("_blocks")).cast("int")
    return whole.join(scales, list(by)).select(*cycle, name.alias("_name"), block.alias("_block"), x.alias("x"))


def _text(df: DataFrame, column: str) -> Column:
    """A cycle's column as it enters the hash of the first centers."""
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return F.col(column).cast("string")


class _Population:
    """The rows of a fit, dealt by block once and kept there for all rounds."""

    def __init__(self, steps: DataFrame, by: Sequence[str], cycle: Sequence[str]):
        if not by:
            steps, by = steps.withColumn("_all", F.lit(0)), ["_all"]
        self.by, self.names = list(by), [c for c in cycle if c not in by]
        rows = stored_copy(_rows(steps, self.by, [*self.by, *self.names]), "rows")
        self.blocks = stored_copy(rows.select(*self.by, "_block").distinct(), "blocks")
        self.rows = rows.repartition(max(self.blocks.count(), 1), *self.by, "_block").persist(StorageLevel.MEMORY_AND_DISK)
        self.by_type = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in self.by)
        self.name_type = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in self.names)

    def meet(self, centers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``work`` on every block with the centers of its population."""
        sent = self.blocks.join(centers, self.by)
        dealt = [*self.by, "_block"]

        return self.rows.groupBy(*dealt).cogroup(sent.groupBy(*dealt)).applyInArrow(work, schema)


def _matrix(table: pa.Table, column: str = "x") -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1) if len(table) else np.zeros((0, 0))


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centers; row by row where they are small, so that 0 is 0."""
    square = (x * x).sum(1)
    out = square[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(1)[None]
    for i, j in np.argwhere(out < 1e-6 * (1 + square[:, None])):
        out[i, j] = ((x[i] - centers[j]) ** 2).sum()
    return out


def _keys_of(table: pa.Table, names: Sequence[str], n: int) -> dict[str, pa.Array]:
    return {c: pa.array([table.column(c)[0].as_py()] * n, table.column(c).type) for c in names}


def _share(name: str, number: int) -> float:
    """A number in (0, 1) from a hash of a cycle and a round."""
    return (int(hashlib.md5(f"{name}|{number}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def _first_centers(population: _Population, k: int) -> DataFrame:
    """``k`` cycles of each population, or all different ones if fewer, numbered in the order drawn."""
    by, shape = population.by, f"{population.by_type}, cluster int, x array<double>"
    schema = f"{population.by_type}, race double, name string, x array<double>"
    spark = population.rows.sparkSession
    chosen = spark.createDataFrame([], shape)

    def draw(number: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def work(rows: pa.Table, near: pa.Table) -> pa.Table:
            x, names = _matrix(rows), rows.column("_name").to_pylist()
            odds = np.array([-np.log(_share(name, number)) for name in names])
            if number:
                gap = _squared(x, _matrix(near)).min(1) if len(near) else np.zeros(len(x))
                odds = np.where(gap > SAME, odds / np.maximum(gap, SAME), np.inf)
            order = sorted(range(len(names)), key=lambda i: (odds[i], names[i]))[:1]
            best = np.array([i for i in order if np.isfinite(odds[i])], np.int64)  # none where all are drawn
            own = _keys_of(rows, by, len(best))
            name = pa.array([names[i] for i in best], pa.string())
            return pa.table({**own, "race": pa.array(odds[best]), "name": name, "x": rows.column("x").take(pa.array(best))})

        return work

    for number in range(k):
        near = population.meet(chosen.select(*by, "x"), draw(number), schema)
        best = near.groupBy(*by).agg(F.min_by("x", F.struct("race", "name")).alias("x"))
        added = stored_copy(best.select(*by, F.lit(number).alias("cluster"), "x"), "center")
        chosen = chosen.unionByName(added)
    return chosen


def _assign(x: np.ndarray, near: pa.Table) -> dict[int, tuple[list[int], np.ndarray, np.ndarray]]:
    """For each k its clusters, all distances to their centers, and the nearest one of every row."""
    out = {}
    ks, clusters = near.column("k").to_numpy(), near.column("cluster").to_numpy()
    distances = _squared(x, _matrix(near))
    for k in sorted(set(ks.tolist())):
        at = np.flatnonzero(ks == k)
        at = at[np.argsort(clusters[at])]  # the lower label in a tie
        out[k] = clusters[at].tolist(), distances[:, at], distances[:, at].argmin(1)
    return out


class Fit:
    """Centers at rest of every population and k, with what scores need: n, mean and mean square."""

    def __init__(self, steps: DataFrame, ks: Iterable[int], by: Sequence[str], cycle: Sequence[str], rounds: int = ROUNDS):
        self.population = _Population(steps, by, cycle)
        self.public = list(by)
        ks = sorted(set(ks))
        by = self.population.by
        seeds = _first_centers(self.population, max(ks))
        ks_column = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
        centers = seeds.select("*", ks_column).filter("cluster < k")
        still = [F.lit(0.0).alias("n"), F.lit(0.0).alias("square"), F.lit(True).alias("moved")]
        centers = stored_copy(centers.select(*by, "k", "cluster", "x", *still), "centers")
        for _ in range(rounds):
            centers = stored_copy(self._next(centers), "centers")
            if centers.filter("moved").isEmpty():
                break
        self.centers = centers

    def _next(self, centers: DataFrame) -> DataFrame:
        by = self.population.by

        def work(rows: pa.Table, near: pa.Table) -> pa.Table:
            x = _matrix(rows)
            found: dict[str, list] = {"k": [], "cluster": [], "n": [], "square": [], "sum": []}
            for k, (clusters, _, label) in _assign(x, near).items():
                for j, cluster in enumerate(clusters):
                    own = x[label == j]
                    if len(own):
                        for name, value in zip(found, (k, cluster, float(len(own)), float((own * own).sum()), own.sum(0)), strict=True):
                            found[name].append(value)
            kinds = {"k": pa.int32(), "cluster": pa.int32(), "n": pa.float64(), "square": pa.float64(), "sum": pa.list_(pa.float64())}
            return pa.table({**_keys_of(rows, by, len(found["k"])), **{c: pa.array(v, kinds[c]) for c, v in found.items()}})

        schema = f"{self.population.by_type}, k int, cluster int, n double, square double, sum array<double>"
        parts = self.population.meet(centers.select(*by, "k", "cluster", "x"), work, schema)
        group = [*by, "k", "cluster"]
        sums = parts.groupBy(*group).agg(
            F.sum("n").alias("_n"), F.sum("square").alias("_square"), vector_to_array(Summarizer.sum(array_to_vector("sum"))).alias("_sum")
        )
        mean = F.transform("_sum", lambda v: v / F.col("_n"))
        # sums of another order differ in the last digits
        far = F.exists(F.zip_with(mean, "x", lambda a, b: F.abs(a - b) > SAME), lambda b: b)
        return centers.drop("n", "square", "moved").join(sums, group, "left").select(
            *group, F.coalesce(mean, "x").alias("x"), F.coalesce("_n", F.lit(0.0)).alias("n"),
            F.coalesce(F.col("_square") / F.col("_n"), F.lit(0.0)).alias("square"), F.coalesce(far, F.lit(False)).alias("moved"),
        )

    def labels(self) -> DataFrame:
        """Label, squared distance and silhouette of every cycle for each k; stored, the rows are let go.

        The silhouette is that of squared distances: their mean over a cluster follows from its
        number, mean and mean square, so no pairs are looked at. Alone in its cluster a
        cycle has 0, as has one whose population has no other cluster.
        """
        by, names = self.population.by, self.population.names

        def work(rows: pa.Table, near: pa.Table) -> pa.Table:
            x = _matrix(rows)
            n, square, ks, cluster_of = (near.column(c).to_numpy() for c in ("n", "square", "k", "cluster"))
            middle = (_matrix(near) ** 2).sum(1)
            parts = []
            for k, (clusters, distance, label) in _assign(x, near).items():
                row_of = {(a, b): i for i, (a, b) in enumerate(zip(ks.tolist(), cluster_of.tolist(), strict=True))}
                at = np.array([row_of[k, c] for c in clusters])
                size = n[at]
                # mean of |x - y|^2 over y is |x - mean|^2 + mean of |y|^2 - |mean|^2
                spread = np.where(size > 0, distance + (square[at] - middle[at])[None], np.inf)
                own = spread[np.arange(len(x)), label] * size[label] / np.maximum(size[label] - 1, 1)
                spread[np.arange(len(x)), label] = np.inf
                other = spread.min(1)
                alone = (size[label] < 2) | np.isinf(other) | (np.maximum(own, other) <= 0)
                score = np.where(alone, 0.0, (np.where(alone, 0.0, other) - own) / np.where(alone, 1.0, np.maximum(own, other)))
                parts.append(
                    pa.table(
                        {
                            **{c: rows.column(c) for c in (*by, *names)},
                            "k": pa.array([k] * len(x), pa.int32()),
                            "cluster": pa.array(np.array(clusters)[label], pa.int32()),
                            "distance": pa.array(np.maximum(distance[np.arange(len(x)), label], 0.0)),
                            "silhouette": pa.array(score),
                        }
                    )
                )
            return pa.concat_tables(parts)

        shape = ", ".join([self.population.by_type, *([self.population.name_type] if names else [])])
        near = self.centers.select(*by, "k", "cluster", "x", "n", "square")
        out = self.population.meet(near, work, f"{shape}, k int, cluster int, distance double, silhouette double")
        out = stored_copy(out, "labels")
        self.population.rows.unpersist()
        return out if self.public else out.drop("_all")


def _cycle_of(keys: Sequence[str]) -> list[str]:
    return [*keys, "cycle_start"]


def cluster_cycles(steps: DataFrame, k: int = 3, keys: Sequence[str] = DEVICE, rounds: int = ROUNDS) -> DataFrame:
    """k-means label of each cycle, all given cycles being one population."""
    return Fit(steps, [k], (), _cycle_of(keys), rounds).labels().select(*keys, "cycle_start", "cluster")


def cluster_devices(steps: DataFrame, k: int = 3, rounds: int = ROUNDS, keys: Sequence[str] = DEVICE) -> DataFrame:
    """k-means label of each cycle within its device, for all devices at once.

    ``steps`` is read several times, so give a stored table. A center without cycles stays where
    it was. Ends when no center moves any more; ``rounds`` only guards against going round in
    circles. Rows and the centers of each round are tables in the shared folder.
    """
    return Fit(steps, [k], keys, _cycle_of(keys), rounds).labels().select(*keys, "cycle_start", "cluster")


def k_sweep(steps: DataFrame, ks: Iterable[int] = range(2, 10), keys: Sequence[str] = DEVICE) -> DataFrame:
    """Cost of each k for every device: the sum of squared distances to the nearest center."""
    labels = Fit(steps, ks, keys, _cycle_of(keys)).labels()
    return labels.groupBy(*keys, "k").agg(F.sum("distance").alias("cost"))


def silhouettes(steps: DataFrame, ks: Iterable[int] = (2, 3, 4, 5), keys: Sequence[str] = DEVICE) -> DataFrame:
    """Mean silhouette (squared distance) of each k for every device."""
    labels = Fit(steps, ks, keys, _cycle_of(keys)).labels()
    return labels.groupBy(*keys, "k").agg(F.avg("silhouette").alias("silhouette"))


# -- what the clusters look like ------------------------------------------------------


def cluster_profiles(steps: DataFrame, labels: DataFrame, keys: Sequence[str] = DEVICE) -> DataFrame:
    """Mean watts per cluster as a step function ``t``..``t_end``; a cycle that has ended counts as 0.

    A sweep over differences: a step adds its watts at its first second and takes them back
    after its last one. Differences of one second combine before the shuffle; running sums are
    taken by bucket of seconds, with the sum of the buckets before. Watts are decimals
    there, so that what was added is taken back without rest.
    """
    by = [*keys, "cluster"]
    sizes = labels.groupBy(*by).agg(F.count("*").alias("cycles"))
    watts = F.col("watts").cast(EXACT)
    ends = F.array(F.struct(F.col("lo").alias("t"), watts.alias("_d")), F.struct((F.col("hi") + 1).alias("t"), (-watts).alias("_d")))
    changes = (
        steps.join(labels, _cycle_of(keys)).select(*by, F.inline(ends))
        .groupBy(*by, "t").agg(F.sum("_d").alias("_d"))
        .withColumn("_bucket", floor_div(F.col("t"), SWEEP_BUCKET))
    )
    buckets = Window.partitionBy(*by).orderBy("_bucket")
    whole = changes.groupBy(*by, "_bucket").agg(F.sum("_d").alias("_whole"), F.min("t").alias("_first"))
    carry = whole.select(
        *by, "_bucket",
        F.coalesce(F.sum("_whole").over(buckets.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(buckets).alias("_next_bucket"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("t")
    return (
        changes.withColumns({"_sum": F.sum("_d").over(inside), "_next": F.lead("t").over(inside)})
        .join(carry, [*by, "_bucket"])
        .join(sizes, by)
        .withColumn("t_end", F.coalesce("_next", "_next_bucket") - 1)
        .filter("t_end is not null")  # the last change is the end of the longest cycle
        .select(*by, "t", "t_end", ((F.col("_sum") + F.col("_before")).cast("double") / F.col("cycles")).alias("watts"))
    )


def cluster_usage(steps: DataFrame, labels: DataFrame, keys: Sequence[str] = DEVICE) -> DataFrame:
    """Use of an average cycle: thousand watt-seconds, as shown in the legend, and kWh.

    Watts by seconds of all steps, without a grid.
    """
    by = [*keys, "cluster"]
    sizes = labels.groupBy(*by).agg(F.count("*").alias("cycles"))
    seconds = F.col("hi") - F.col("lo") + 1
    totals = steps.join(labels, _cycle_of(keys)).groupBy(*by).agg(F.sum(F.col("watts").cast(EXACT) * seconds).cast("double").alias("_sum"))
    watt_seconds = F.col("_sum") / F.col("cycles")
    return totals.join(sizes, by).select(
        *by, F.bround(watt_seconds / 1000, 0).alias("kws"), (watt_seconds / WATT_SECONDS_PER_KWH).alias("kwh")
    )
