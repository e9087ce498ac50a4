"""Approximate nearest neighbours with balanced posting lists.

Vectors are dealt to the lists of a few thousand centroids, fitted on a bounded sample so that
lists are of like size. A vector near a boundary is replicated to several lists. Centroids are
searched through a graph of their neighbours that every task holds in memory; a query visits
all lists whose centroid is not farther than the nearest one by more than a ratio. That ratio is
measured on the data at hand: some queries are scored against all vectors, and it is the least
one with which the search finds RECALL of their neighbours. Lists are joined with the queries
that visit them, block by block, first the few nearest lists of each query. Of the others only
candidates no worse than the last of the best found so far are given back, so that their number
follows the queries, not the lists visited. The best of all blocks are ranked.

The largest inner product is the least distance once each vector has one more component that
gives all the same length; centroids and boundaries use that distance, scores the original
vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from homegrid.llm.arrow import column_of
from homegrid.session import stored_copy

#: Vectors in a list, centroids at most, and vectors in the sample that centroids are fitted on.
LIST, CENTROIDS, SAMPLE = 256, 4096, 40_000
#: Lists that a vector is put in at most, how much farther than its nearest one they may be, and
#: by how much (squared) two centroids may be nearer to each other than to the vector.
REPLICAS, BOUNDARY, ALIKE = 4, 1.20, 16
#: Lists that a query looks at, at least.
VISITED_LEAST = 8
#: Queries that are scored against all vectors, and the part of their neighbours that the visited lists must hold.
MEASURED, RECALL = 200, 0.97
#: Links of a centroid, centroids in a beam at first, and where searches start. A beam of 1 / DENSE of all is no longer searched by graph.
NEIGHBOURS, BEAM, ENTRIES, DENSE = 24, 96, 32, 8
BLOCK = 2048


@dataclass
class Graph:
    """Centroids and, for each, its nearest other ones and a few far ones."""

    centers: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @staticmethod
    def build(centers: np.ndarray, seed: int = 5) -> Graph:
        k = len(centers)
        rng, width = np.random.default_rng(seed), min(NEIGHBOURS, max(1, k - 1))
        links = np.zeros((k, width), np.int64)
        norm = (centers**2).sum(1)
        for a in range(0, k, 512):
            d = norm[None, :] - 2 * centers[a : a + 512] @ centers.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near = np.argsort(d, axis=1, kind="stable")[:, :width]
            links[a : a + 512] = near
        if k > 4 * NEIGHBOURS:
            links[:, -4:] = rng.integers(0, k, (k, 4))
        return Graph(centers, links, np.sort(rng.permutation(k)[:ENTRIES]))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first for many vectors at once: the ``beam`` nearest centroids found, and squared distances.

        Each round expands the nearest few centroids of every beam which were not expanded yet,
        until no beam has any left.
        """
        n, k = len(x), len(self.centers)
        beam = min(beam, k)
        norm, own = (self.centers**2).sum(1), (x**2).sum(1)

        def distance(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            return own[rows][:, None] + norm[at] - 2 * np.einsum("rd,rjd->rj", x[rows], self.centers[at])

        ids = np.full((n, beam), -1)
        dist = np.full((n, beam), np.inf)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, k), bool)
        begin = np.broadcast_to(self.entries, (n, len(self.entries)))
        rows, fresh, open_ = np.arange(n), begin, np.ones(begin.shape, bool)
        while len(rows):
            seen[rows[:, None], fresh] = True
            d = np.where(open_, distance(rows, fresh), np.inf)
            all_i = np.concatenate([ids[rows], fresh], 1)
            all_d = np.concatenate([dist[rows], d], 1)
            all_done = np.concatenate([done[rows], ~open_], 1)
            keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            ids[rows], dist[rows], done[rows] = (np.take_along_axis(v, keep, 1) for v in (all_i, all_d, all_done))
            rows = np.flatnonzero((~done).any(1))
            if not len(rows):
                break
            order = np.argsort(np.where(done[rows], np.inf, dist[rows]), axis=1, kind="stable")[:, :4]
            pick = np.take_along_axis(ids[rows], order, 1)
            real = ~np.take_along_axis(done[rows], order, 1)
            flags = done[rows]
            np.put_along_axis(flags, order, True, 1)
            done[rows] = flags
            fresh = self.links[np.where(real, pick, pick[:, :1])].reshape(len(rows), -1)
            open_ = ~seen[rows[:, None], fresh]
            first = np.sort(fresh, axis=1)  # a centroid reached twice in a round counts once
            place = np.argsort(fresh, axis=1, kind="stable")
            again = np.concatenate([np.zeros((len(rows), 1), bool), first[:, 1:] == first[:, :-1]], 1)
            repeat = np.zeros_like(again)
            np.put_along_axis(repeat, place, again, 1)
            open_ &= ~repeat
        return ids, dist

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of each vector to all centroids."""
        return np.maximum(0, (x**2).sum(1)[:, None] + (self.centers**2).sum(1) - 2 * x @ self.centers.T)

    def visits(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        return self.ranked_visits(x, ratio)[:2]

    def ranked_visits(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, rank from 0) of all whose squared distance is within ``ratio`` of the nearest one's, and of the first few.

        Where a beam ends before the ratio does, it is made four times as wide, up to all centroids.
        """
        k, beam, rows, found = len(self.centers), BEAM, np.arange(len(x)), []
        while len(rows):
            if beam * DENSE >= k:
                dist = self.distances(x[rows])
                ids = np.argsort(dist, axis=1, kind="stable")
                dist = np.take_along_axis(dist, ids, 1)
            else:
                ids, dist = self.search(x[rows], beam)
            real = ids >= 0
            use = real & ((dist <= ratio * np.maximum(dist[:, :1], 1e-12)) | (np.arange(ids.shape[1]) < VISITED_LEAST))
            n = real.sum(1)
            more = (use.sum(1) == n) & (n < k)
            row, j = np.nonzero(use & ~more[:, None])
            found.append((rows[row], ids[row, j], j))
            rows, beam = rows[more], 4 * beam
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def fit_ratio(graph: Graph, x: np.ndarray, query: np.ndarray, vector: np.ndarray, lists: np.ndarray) -> float:
    """The least ratio with which visits of ``x`` hold RECALL of their neighbours; infinite where none is known.

    ``query``, ``vector`` and ``lists`` say that a neighbour of a row of ``x`` is in a list.
    """
    if not len(query):
        return float("inf")
    dist = graph.distances(x)
    place = np.argsort(np.argsort(dist, axis=1, kind="stable"), axis=1, kind="stable")
    need = dist[query, lists] / np.maximum(dist.min(1), 1e-12)[query]
    need[place[query, lists] < VISITED_LEAST] = 0
    order = np.lexsort((vector, query))
    head = np.flatnonzero(np.concatenate([[True], (np.diff(query[order]) != 0) | (np.diff(vector[order]) != 0)]))
    least = np.sort(np.minimum.reduceat(need[order], head))
    at = int(np.ceil(RECALL * len(least))) - 1
    while True:  # the graph may miss some of what is within the ratio
        ratio = max(1.0, least[at] * (1 + 1e-9)) if at < len(least) else float("inf")
        seen = np.zeros(dist.shape, bool)
        seen[graph.visits(x, ratio)] = True
        if ratio == float("inf") or np.logical_or.reduceat(seen[query, lists][order], head).mean() >= RECALL:
            return float(ratio)
        at += max(1, len(least) // 200)


def exact_neighbours(vectors: DataFrame, ids: np.ndarray, q: np.ndarray, top: int) -> DataFrame:
    """(query, vec_id): the ``top`` best of all vectors for each row of a few queries ``q``, without its own id."""
    sent = vectors.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, q_ = sent.value
        best, score = np.zeros((len(q_), 0), np.int64), np.zeros((len(q_), 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            own = column_of(batch, "vec_id").to_numpy(zero_copy_only=False)
            s = q_ @ _matrix(column_of(batch, "v")).T
            s[ids_[:, None] == own[None, :]] = -np.inf
            score = np.concatenate([score, s], 1)
            best = np.concatenate([best, np.broadcast_to(own, s.shape)], 1)
            if score.shape[1] > top:
                keep = np.argpartition(-score, top - 1, axis=1)[:, :top]
                best, score = np.take_along_axis(best, keep, 1), np.take_along_axis(score, keep, 1)
        row, j = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int64)), pa.array(best[row, j]), pa.array(score[row, j])], ["query", "vec_id", "score"])

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return vectors.mapInArrow(run, "query long, vec_id long, score double").withColumn("r", place).where(F.col("r") <= top).select("query", "vec_id")


def fit_centers(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """K-means whose distances grow with the size of a list, so that lists stay of like size."""
    rng = np.random.default_rng(seed)
    k = min(k, len(sample))
    centers = sample[np.sort(rng.permutation(len(sample))[:k])].copy()
    price = np.zeros(k)
    scale = float(sample.var(0).sum()) or 1.0
    for _ in range(rounds):
        norm = (centers**2).sum(1) + price
        best = np.concatenate([(norm[None, :] - 2 * sample[a : a + 2048] @ centers.T).argmin(1) for a in range(0, len(sample), 2048)])
        size = np.bincount(best, minlength=k)
        order = np.argsort(best, kind="stable")
        used = np.flatnonzero(size)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])[used]
        centers[used] = np.add.reduceat(sample[order], starts) / size[used][:, None]
        price += 0.05 * scale * (size / max(1.0, len(sample) / k) - 1).clip(-1, 3)
    return centers


def valid_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part: no null, non-finite or all-zero vector."""
    v = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(finite & F.exists("v", lambda x: x != 0))
    sizes = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("v") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def best_of(found: DataFrame, top: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` best of each query's candidates, each counted once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(rows: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products found for each query.

    Queries are the rows whose vec_id ``every`` divides, candidates all rows but the query's
    own, nearest first and ties by the smaller vec_id. Rows with a null, zero or non-finite
    vector, without an id, or with another dimension than most take no part. Of equal vectors
    only the first ``top`` + 1 by id can be among the nearest, so the others are not looked at.
    An empty table gives no rows; of repeated rows one counts. The lists that are visited hold
    RECALL of the neighbours of MEASURED queries, however many lists that takes.
    """
    spark = rows.sparkSession
    data = stored_copy(valid_vectors(rows).dropDuplicates(["vec_id"]), "vectors")
    facts = data.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], out)
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = data.withColumn("r", first).where(F.col("r") <= top + 1).drop("r")
    fine = 1_000_000
    part = min(1.0, SAMPLE / facts["n"])
    picked = data.where(F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(fine)) < int(part * fine) + 1).select("v").toArrow()
    sample = _matrix(picked.column("v").combine_chunks()) if picked.num_rows else _matrix(data.limit(100).select("v").toArrow().column("v").combine_chunks())
    longest = float(facts["longest"])

    def lifted(x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros((len(x), 1)) if query else np.sqrt(np.maximum(0, longest - (x**2).sum(1)))[:, None]
        return np.concatenate([x, more], 1)

    k = int(np.clip(-(-facts["n"] // LIST), 1, CENTROIDS))
    sent = spark.sparkContext.broadcast(Graph.build(fit_centers(np.unique(lifted(sample), axis=0), k)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part_ = batch.slice(a, 1000)
                x = lifted(_matrix(column_of(part_, "v")))
                ids, dist = graph.search(x, 16)
                row, to = [], []
                for j in range(min(REPLICAS, ids.shape[1])):
                    use = dist[:, j] <= BOUNDARY**2 * np.maximum(dist[:, 0], 1e-12)
                    for i in range(j):  # not if an earlier list's centroid is nearly the same
                        apart = ((graph.centers[ids[:, i]] - graph.centers[ids[:, j]]) ** 2).sum(1)
                        use &= ALIKE * apart > dist[:, j]
                    if j == 0:
                        use[:] = True
                    row.append(np.flatnonzero(use))
                    to.append(ids[use, j])
                row, to = np.concatenate(row), np.concatenate(to)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), column_of(part_, "vec_id").take(take), column_of(part_, "v").take(take)], ["list", "vec_id", "v"])

    def visit(first: bool):
        """The queries at the few lists nearest to them, or at the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph = sent.value
            for batch in batches:
                for a in range(0, batch.num_rows, 500):
                    part_ = batch.slice(a, 500)
                    row, to, rank = graph.ranked_visits(lifted(_matrix(column_of(part_, "v")), True), ratio)
                    use = (rank < VISITED_LEAST) == first
                    take = pa.array(row[use])
                    columns = [column_of(part_, c).take(take) for c in ("vec_id", "v", "floor")]
                    yield pa.RecordBatch.from_arrays([pa.array(to[use].astype(np.int64)), *columns], ["list", "query_id", "q", "floor"])

        return run

    lists = stored_copy(kept.mapInArrow(deal, "list long, vec_id long, v array<double>"), "lists")
    queries = data.where(F.pmod("vec_id", F.lit(every)) == 0)
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(MEASURED).toArrow()
    ratio = float("inf")
    if some.num_rows:
        q = _matrix(some.column("v").combine_chunks())
        exact = exact_neighbours(kept, some.column("vec_id").to_numpy(), q, top)
        # MEASURED * top rows
        held = lists.select("vec_id", "list").join(F.broadcast(exact), "vec_id").toArrow()
        ratio = fit_ratio(sent.value, lifted(q, True), *(held.column(c).to_numpy() for c in ("query", "vec_id", "list")))
    blocks = lists.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # CENTROIDS rows at most
    dealt = lists.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    dealt = dealt.select("list", "block", "vec_id", "v")
    spread = blocks.select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))

    def score(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        vectors = vectors.sort_values("vec_id")
        v, ids = np.stack(vectors.v.to_numpy()), vectors.vec_id.to_numpy()
        parts = []
        for a in range(0, len(queries), 512):
            some = queries.iloc[a : a + 512]
            q, q_ids, floor = np.stack(some.q.to_numpy()), some.query_id.to_numpy(), some.floor.to_numpy()
            rough = q @ v.T
            rough[q_ids[:, None] == ids[None, :]] = -np.inf
            n = min(2 * top + 24, len(ids))
            best = np.argpartition(-rough, n - 1, axis=1)[:, :n]
            row = np.repeat(np.arange(len(q)), n)
            at = best.ravel()
            exact = np.einsum("rd,rd->r", q[row], v[at])  # in one order, so that equal vectors tie
            good = (q_ids[row] != ids[at]) & (exact >= floor[row])
            row, at, exact = row[good], at[good], exact[good]
            order = np.lexsort((ids[at], -exact, row))
            row, at, exact = row[order], at[order], exact[order]
            head = np.searchsorted(row, np.arange(len(q)))
            use = np.arange(len(row)) - head[row] < top
            parts.append(pd.DataFrame({"query_id": q_ids[row[use]], "vec_id": ids[at[use]], "score": exact[use]}))
        return pd.concat(parts)

    def candidates(first: bool, asking: DataFrame) -> DataFrame:
        asked = asking.select("vec_id", "v", "floor").mapInArrow(visit(first), "list long, query_id long, q array<double>, floor double")
        asked = asked.join(spread, "list").select("list", "part", "query_id", "q", "floor")
        return dealt.groupBy("list", "block").cogroup(asked.groupBy("list", "part")).applyInPandas(score, "query_id long, vec_id long, score double")

    any_score = F.lit(float("-inf"))
    best = stored_copy(best_of(candidates(True, queries.withColumn("floor", any_score)), top), "best")
    last = best.where(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    others = candidates(False, queries.join(last, "vec_id", "left").withColumn("floor", F.coalesce("floor", any_score)))
    return best_of(best.drop("rank").unionByName(others), top)
