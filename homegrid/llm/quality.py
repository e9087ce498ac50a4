"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage is described by counts of its
bytes and words, encoded to a hidden vector, and weighted by gated attention that is learned
from document labels alone; the weighted mean of the hidden vectors gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from homegrid.llm.arrow import SPACES, byte_set, chunks, column_of, lower_table, span_hashes, spans
from homegrid.llm.labels import log_odds, remainder, training_sample

PASSAGE = 48
#: Documents of each label that the model is fitted on, at most.
TRAINED_ON = 2500
HIDDEN, GATE = 16, 8

UPPER = byte_set(bytes(range(65, 91)))
LOWER = byte_set(bytes(range(97, 123)))
DIGIT = byte_set(b"0123456789")
SIGN = byte_set(bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,"))
STOP = byte_set(b".,;:?!")
LINE = byte_set(b"\n")
OTHER = byte_set(bytes(range(128, 256)))
CLASSES = (UPPER, LOWER, DIGIT, SIGN, STOP, LINE, OTHER)
WIDTH = len(CLASSES) + 9


def passages(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of all passages, and per row the number of the first one (n + 1 entries)."""
    starts, ends = spans(~byte_set(SPACES)[data], at)
    first = np.searchsorted(starts, at)
    words = np.diff(first)
    per_row = -(-words // PASSAGE)
    bag = np.concatenate([[0], np.cumsum(per_row)])
    if not len(starts):
        return np.zeros((0, WIDTH), np.float32), bag
    row = np.repeat(np.arange(len(words)), words)
    which = bag[row] + (np.arange(len(starts)) - first[row]) // PASSAGE  # passage of each word
    head = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
    n = np.diff(np.concatenate([head, [len(starts)]])).astype(np.float32)
    lo, hi = starts[head], ends[np.concatenate([head[1:], [len(starts)]]) - 1]
    size = (hi - lo).astype(np.float32)
    columns = []
    for members in CLASSES:
        total = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        columns.append((total[hi] - total[lo]) / size)
    hashes = span_hashes(lower_table()[data], starts, ends)
    length = (ends - starts).astype(np.float32)
    mean = np.add.reduceat(length, head) / n
    spread = np.sqrt(np.maximum(0, np.add.reduceat(length * length, head) / n - mean * mean))

    def share(flag: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flag.astype(np.float32), head) / n

    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (which[1:] == which[:-1])])
    key = np.sort((which.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    owner = (key >> np.uint64(40)).astype(np.int64)
    distinct = np.bincount(owner[fresh], minlength=len(head)).astype(np.float32) / n
    edge = SIGN[data[starts]] | SIGN[data[ends - 1]]
    columns += [mean / 10, spread / 10, share(same), distinct, share(edge), share(length <= 1), share(UPPER[data[starts]]), share(length > 20), np.log1p(n) / 4]
    return np.stack(columns, 1).astype(np.float32), bag


class Model:
    """Standardized passages to a score; ``weights`` are arrays by name."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def new(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        p = float(np.clip(y.mean(), 0.01, 0.99))
        return Model(
            {
                "mean": x.mean(0), "scale": x.std(0) + 1e-3,
                "w1": rng.normal(0, 0.3, (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
                "v": rng.normal(0, 0.3, (HIDDEN, GATE)), "u": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": np.zeros(GATE),
                "c": rng.normal(0, 0.1, HIDDEN), "c0": np.array([np.log(p / (1 - p))]),
            }
        )

    def forward(self, x: np.ndarray, bag: np.ndarray) -> dict:
        """Hidden vectors, attention and logits; an empty bag has the zero vector."""
        w = self.w
        s = np.clip((x - w["mean"]) / w["scale"], -8, 8)
        h = np.tanh(s @ w["w1"] + w["b1"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = np.clip((t * g) @ w["a"], -30, 30)
        row = np.repeat(np.arange(len(bag) - 1), np.diff(bag))
        expo = np.exp(e)
        weight = expo / np.bincount(row, expo, minlength=len(bag) - 1)[row] if len(row) else expo
        z = np.zeros((len(bag) - 1, h.shape[1]))
        full = np.flatnonzero(np.diff(bag))
        if len(full):
            z[full] = np.add.reduceat(weight[:, None] * h, bag[full], axis=0)
        return {"s": s, "h": h, "t": t, "g": g, "row": row, "weight": weight, "z": z, "logit": z @ w["c"] + w["c0"][0]}

    def scores(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, bag)["logit"], -40, 40)))

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, f = self.w, self.forward(x, bag)
        dl = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        dz = dl[:, None] * w["c"]
        row, weight, h, t, g = f["row"], f["weight"], f["h"], f["t"], f["g"]
        dzr = dz[row]
        dot = (dzr * (h - f["z"][row])).sum(1) * weight  # through the softmax
        dh = dzr * weight[:, None]
        dt, dg = dot[:, None] * w["a"] * g * (1 - t * t), dot[:, None] * w["a"] * t * g * (1 - g)
        dh += dt @ w["v"].T + dg @ w["u"].T
        db = dh * (1 - h * h)
        return {
            "w1": f["s"].T @ db, "b1": db.sum(0), "v": h.T @ dt, "u": h.T @ dg,
            "a": (dot[:, None] * t * g).sum(0), "c": f["z"].T @ dl, "c0": np.array([dl.sum()]),
        }

    def fit(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4) -> Model:
        """Adam over batches of documents."""
        rng, step = np.random.default_rng(11), 0
        moments = {k: [np.zeros_like(self.w[k]), np.zeros_like(self.w[k])] for k in ("w1", "b1", "v", "u", "a", "c", "c0")}
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for docs in np.array_split(order, max(1, len(y) // 128)):
                take = np.concatenate([np.arange(bag[d], bag[d + 1]) for d in docs])
                part = np.concatenate([[0], np.cumsum(bag[docs + 1] - bag[docs])])
                step += 1
                for k, grad in self.gradients(x[take], part, y[docs]).items():
                    m, v = moments[k]
                    grad = grad + decay * self.w[k]
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    self.w[k] = self.w[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = TRAINED_ON) -> Model | None:
    """The model of at most ``most`` documents of each label outside the held-out fold; None if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches):
            x, bag = passages(data, at)
            rows = [x[bag[i] : bag[i + 1]].tobytes() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "doc_id").cast(pa.int64()), column_of(part, "label"), pa.array(rows, pa.binary())], ["doc_id", "label", "x"]
            )

    sample, share = training_sample(docs, labels, column, most)
    bags = sorted(sample.mapInArrow(run, "doc_id long, label int, x binary").collect())
    if not bags:
        return None
    xs = [np.frombuffer(r.x, np.float32).reshape(-1, WIDTH) for r in bags]
    x = np.concatenate(xs).astype(np.float64)
    if not len(x):
        return None
    bag = np.concatenate([[0], np.cumsum([len(v) for v in xs])])
    y = np.array([r.label for r in bags], np.float64)
    model = Model.new(x, y).fit(x, bag, y)
    model.w["c0"] = model.w["c0"] + log_odds(share) - log_odds(y.mean())  # the sample has even labels
    return model


def score_quality(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null or empty text is an empty bag, whose score is the model's base rate; without a
    model every score is 0.5. A null doc_id is never held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches):
            x, bag = passages(data, at)
            score = np.full(part.num_rows, 0.5) if model is None else model.scores(x, bag)
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "doc_id"), column_of(part, "held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (remainder(5) == 0).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is ``threshold`` or more, with all their columns."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches):
            x, bag = passages(data, at)
            score = np.full(part.num_rows, 0.5) if model is None else model.scores(x, bag)
            yield part.filter(pa.array(score >= threshold)).select(names)

    return docs.mapInArrow(run, docs.schema)
