"""Removal of repeated byte strings by distributed prefix doubling over chosen positions.

Two positions are alike for LENGTH bytes if they have the same pair of ranks: that of the
bytes at them and that of the bytes at an offset. Ranking every byte of a corpus would move
its size many times over, so the positions that can't repeat leave first, round by round:

1. Every string of LENGTH bytes has one anchor, the GRAM bytes with the least hash in it, and
   equal strings have equal anchors at equal places. Anchors are ranked by their bytes; those
   that only one document has are unique, and all strings around them are too.
2. The others are ranked by the pair (anchor, all bytes of the strings around it). Documents
   after the first with the same pair repeat all of these strings.
3. Where one anchor has several surroundings, each string around it is ranked by the pair of
   its halves' ranks, the second at the offset LENGTH / 2, in its first document. Sorted by
   pair, a position repeats if the least document of its pair is smaller than its own. These
   places go to their texts by a join, and strings are ranked in parts by pair, one after the
   other, so that no part shuffles more than the size of the texts, however many strings there are.

Ranks are 64-bit names made from the bytes, equal for equal strings. What passes from the first
round to the second on the driver is a bit table of fixed size, whose chance hits only cost work:
one row of the second round for an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from homegrid.llm.arrow import CHUNK, _BASE, _BYTES, _INVERSE, _power, chunks, column_of, mix, text_bytes
from homegrid.session import drop_stored, shuffles_dropped, stored_copy

GRAM = 24
#: Bits of the tables of repeated anchors and of ids with several texts.
BITS = 1 << 27
#: Bytes of a shuffle that a ranked string takes.
ROW = 16
#: Texts are read in pieces of so many bytes, which overlap by one string.
PIECE = 1 << 20
PLACE = 26
#: A place and a length below this are packed into one long.
SPREAD = 1 << 20


class Sums:
    """Running polynomial sums of some bytes: the rank of any substring at once."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(_BASE, n), out=self.total[1:])
        self.inverse = _power(_INVERSE, n + 1)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.total[b] - self.total[a]) * self.inverse[a] + (b - a).astype(np.uint64))


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[Sums, dict[str, np.ndarray]]:
    """For every anchor its row, place, rank and the range ``lo`` to ``hi`` of its strings' starts."""
    empty = {k: np.zeros(0, np.int64) for k in ("row", "place", "lo", "hi")} | {"gram": np.zeros(0, np.uint64)}
    n = len(data)
    sums = Sums(data)
    if n < length:
        return sums, empty
    grams = np.arange(n - GRAM + 1)
    rank = sums.rank(grams, grams + GRAM)
    low = np.uint64((1 << PLACE) - 1)
    best, have, want = (rank & ~low) | grams.astype(np.uint64), 1, length - GRAM + 1
    while have < want:  # the least of ``want`` neighbours, leftmost of equal ones
        step = min(have, want - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts = np.flatnonzero(row[: n - length + 1] == row[length - 1 :])
    if not len(starts):
        return sums, empty
    place = (best[starts] & low).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[starts[1:]] != row[starts[:-1]])]))
    lo, hi = starts[head], starts[np.concatenate([head[1:], [len(starts)]]) - 1]
    place = place[head]
    return sums, {"row": row[lo], "place": place, "lo": lo, "hi": hi, "gram": rank[place]}


def pieces(batches: Iterator[pa.RecordBatch], length: int, *more: str) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_id of each row, byte offset of each row in its text, bytes, row offsets, ``more`` columns); long texts in pieces."""
    for part, data, at in chunks(batches, "text", CHUNK // 4):
        ids = column_of(part, "doc_id").to_numpy(zero_copy_only=False)
        rest = [column_of(part, c).to_numpy(zero_copy_only=False) for c in more]
        if len(data) <= 2 * PIECE:
            yield ids, np.zeros(len(ids), np.int64), data, at, *rest
            continue
        for a in range(0, len(data) - length + 1, PIECE):  # one long text
            cut = data[a : a + PIECE + length - 1]
            yield ids, np.array([a]), cut, np.array([0, len(cut)]), *rest


def bit_table(values: DataFrame) -> np.ndarray:
    """The fixed-size bit table of the longs in the column ``value``."""
    with shuffles_dropped(values.sparkSession):
        words = _words(values).toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint64)


def _words(values: DataFrame) -> DataFrame:
    return (
        values.select(F.shiftright(F.col("value").bitwiseAND(F.lit(BITS - 1)), 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(value & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )


def has(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    spot = values & np.uint64(BITS - 1)
    return (table[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def version_of(text: str) -> Column:
    """A hash that tells different texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _strings(length: int, part: int, parts: int):
    """(pair, doc_id, version, start) of the strings at the ``spots`` of a text whose pair belongs to ``part``."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in chunks(batches, "text", CHUNK // 4):
            ids, version = (column_of(batch, c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
            spots = column_of(batch, "spots")
            row = np.repeat(np.arange(len(ids)), spots.value_lengths().to_numpy(zero_copy_only=False))
            spot = spots.flatten().to_numpy(zero_copy_only=False)
            first = at[row] + spot // SPREAD
            after = first + spot % SPREAD + 1
            for a in range(0, len(data) - length + 1, PIECE):  # more than one in a long text
                sums = Sums(data[a : a + PIECE + length - 1])
                here = np.flatnonzero((after > a) & (first < a + PIECE))
                lo = np.maximum(first[here], a) - a
                n = np.minimum(after[here], a + PIECE) - a - lo
                s = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                pair = mix(sums.rank(s, s + half) * np.uint64(0xD1342543DE82EF95) + sums.rank(s + half, s + length))
                r = np.repeat(row[here], n)
                if parts > 1:
                    mine = (pair >> np.uint64(40)) % np.uint64(parts) == part
                    s, pair, r = s[mine], pair[mine], r[mine]
                yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(ids[r]), pa.array(version[r]), pa.array(s + a - at[r])], ["pair", "doc_id", "version", "start"])

    return run


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, version, start, end): bytes of strings of ``length`` that a document with a smaller id has too.

    Spans may overlap and touch. Rows without an id or with less text than ``length`` give none.
    ``version`` is 0 for an id with one text, else it tells which of its texts has the span.
    """
    return _spans(docs, length)[0]


def _spans(docs: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """What repeated_spans gives, and the stored tables that it reads."""
    if not GRAM < length <= SPREAD // 4:
        raise ValueError(f"strings of {GRAM + 1} to {SPREAD // 4} bytes")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", version_of("text").alias("version")).where("doc_id is not null and text is not null")
    differ = texts.groupBy("doc_id").agg(F.min("version").alias("a"), F.max("version").alias("b")).where("a <> b")
    several = spark.sparkContext.broadcast(bit_table(differ.select(F.col("doc_id").alias("value"))))

    def told_apart(ids: np.ndarray, version: np.ndarray) -> np.ndarray:
        return np.where(has(several.value, ids.astype(np.int64).view(np.uint64)), version, 0)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, data, at in pieces(batches, length):
            _, found = anchors(data, at, length)
            yield pa.RecordBatch.from_arrays([pa.array(found["gram"].view(np.int64)), pa.array(ids[found["row"]])], ["gram", "doc_id"])

    ranked = texts.mapInArrow(first, "gram long, doc_id long").groupBy("gram").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = spark.sparkContext.broadcast(bit_table(ranked.where("a <> b").select(F.col("gram").alias("value"))))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for ids, offset, data, at, version in pieces(batches, length, "version"):
            sums, found = anchors(data, at, length)
            use = has(table, found["gram"])
            row, place, lo, hi = (found[k][use] for k in ("row", "place", "lo", "hi"))
            around = sums.rank(lo, hi + length) + mix(((hi - lo) * SPREAD + (place - lo)).astype(np.uint64))
            start = lo - at[row] + offset[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["gram"][use].view(np.int64)), pa.array(around.view(np.int64)), pa.array(ids[row]), pa.array(told_apart(ids[row], version[row])), pa.array(start * SPREAD + (hi - lo))],
                ["gram", "around", "doc_id", "version", "spot"],
            )

    alive = texts.mapInArrow(second, "gram long, around long, doc_id long, version long, spot long")
    by_gram, by_pair = Window.partitionBy("gram"), Window.partitionBy("gram", "around")
    told = (
        alive.withColumn("g_least", F.min("doc_id").over(by_gram)).withColumn("g_most", F.max("doc_id").over(by_gram))
        .withColumn("one", F.min("around").over(by_gram) == F.max("around").over(by_gram))
        .where("g_least <> g_most").withColumn("least", F.min("doc_id").over(by_pair))
        .where("doc_id > least or not one").select("doc_id", "version", "spot", (F.col("doc_id") > F.col("least")).alias("whole"))
    )
    told = stored_copy(told, "anchors")
    start = F.shiftright("spot", 20)
    whole = told.where("whole").select("doc_id", "version", start.cast("long").alias("start"), (start + F.col("spot") % SPREAD + length).cast("long").alias("end"))
    spots = told.where("not whole").groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).agg(F.collect_set("spot").alias("spots"))
    of_text = (F.col("doc_id") == F.col("_id")) & ((F.col("_version") == 0) | (F.col("_version") == F.col("version")))
    around = stored_copy(texts.join(spots, of_text).select("doc_id", F.col("_version").alias("version"), "text", F.octet_length("text").alias("size"), "spots"), "around")
    n_bytes = around.agg(F.sum("size")).first()[0] or 1
    n_strings = told.where("not whole").agg(F.sum(F.col("spot") % SPREAD + 1)).first()[0] or 0
    parts = max(1, -(-ROW * n_strings // n_bytes))
    found = []
    for part in range(parts):
        strings = around.mapInArrow(_strings(length, part, parts), "pair long, doc_id long, version long, start long")
        again = strings.withColumn("least", F.min("doc_id").over(Window.partitionBy("pair"))).where("doc_id > least")
        found.append(stored_copy(again.select("doc_id", "version", "start"), "again"))
    drop_stored(around)
    spans = [whole, *(again.select("doc_id", "version", "start", (F.col("start") + length).alias("end")) for again in found)]
    return reduce(DataFrame.unionByName, spans), [told, *found]


def merged(spans: np.ndarray) -> np.ndarray:
    """(start, end) rows to disjoint runs in order; runs that touch become one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    head = np.flatnonzero(new)
    return np.stack([spans[head, 0], reach[np.concatenate([head[1:], [len(spans)]]) - 1]], 1)


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    found, stored = _spans(docs, length)
    packed = found.select("doc_id", "version", (F.col("start") * SPREAD + F.col("end") - F.col("start")).alias("span"))
    spans = stored_copy(packed.groupBy("doc_id", "version").agg(F.collect_list("span").alias("_spans")).withColumnsRenamed({"doc_id": "_id", "version": "_version"}), "spans")
    drop_stored(*stored)
    mine = (docs["doc_id"].cast("long") == spans["_id"]) & ((spans["_version"] == 0) | (spans["_version"] == version_of("text")))
    return docs.join(spans, mine, "left").drop("_id", "_version")


def _cut(text: np.ndarray, packed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that stay, and the runs that go."""
    if packed is None or not len(packed):
        return text, np.zeros((0, 2), np.int64)
    start = packed // SPREAD
    runs = merged(np.stack([start, start + packed % SPREAD], 1))
    stay = np.ones(len(text) + 1, np.int8)
    delta = np.zeros(len(text) + 1, np.int8)
    delta[runs[:, 0]] += 1
    delta[runs[:, 1]] -= 1
    stay = np.cumsum(delta[:-1]) == 0
    return text[stay], runs


def span_digests(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row; a null text is empty.

    Rows that share an id are one document: neither repeats the other, and each has the spans of
    its own text. A null id keeps its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(column_of(batch, "text"))
            spans = column_of(batch, "_spans")
            n, gone, runs_of, digest = [], [], [], []
            for i in range(batch.num_rows):
                text = data[at[i] : at[i + 1]]
                packed = spans[i].values
                kept, runs = _cut(text, None if packed is None else packed.to_numpy(zero_copy_only=False))
                n.append(len(text))
                gone.append(len(text) - len(kept))
                runs_of.append(len(runs))
                digest.append(hashlib.sha256(kept.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs_of, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), length)
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` without the repeated bytes; a letter that is cut in part becomes U+FFFD. Null texts stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = column_of(batch, "text"), column_of(batch, "_spans")
            new = []
            for i in range(batch.num_rows):
                text, packed = texts[i].as_py(), spans[i].values
                if text is not None and packed is not None and len(packed):
                    kept, _ = _cut(np.frombuffer(text.encode(), np.uint8), packed.to_numpy(zero_copy_only=False))
                    text = kept.tobytes().decode("utf-8", "replace")
                new.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if c == "text" else column_of(batch, c) for c in names], names)

    return _with_spans(docs, length).mapInArrow(run, docs.schema)
