"""Line deduplication: hashes in range partitions, read in order, answered by keep bitmaps.

Every line becomes (hash, document, position). The rows are range-partitioned by hash and
document and sorted by hash, document, position; since the range also has the document, the
rows of a hot line are spread over as many partitions as they need. Each partition is read
once, in order. What a partition can't decide alone are its first and last lines, which may
go on in its neighbours: for these it returns counts, two rows at most, and the few rows that
are still open. The result is a compressed bitmap per document, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from homegrid.llm.arrow import SPACES, column_of
from homegrid.session import stored_copy

DROP, OPEN, EDGE = 0, 1, 2
FOUND = "kind int, h1 long, h2 long, doc_id long, version long, position long, docs long"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "version", F.xxhash64("text")
    )


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row for each line with a key: h1, h2 (128 bits), doc_id, version, position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                keys, where, row = [], [], []
                for i, text in enumerate(column_of(part, "text").to_pylist()):
                    for at, line in enumerate(text.encode("utf-8").split(b"\n")):
                        if key := line_key(line):
                            keys.append(xxhash.xxh3_128_digest(key))
                            where.append(at)
                            row.append(i)
                both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                take = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), column_of(part, "doc_id").take(take), column_of(part, "version").take(take), pa.array(where, pa.int64())],
                    ["h1", "h2", "doc_id", "version", "position"],
                )

    return _keyed(docs).mapInArrow(run, "h1 long, h2 long, doc_id long, version long, position long")


def _stream(min_docs: int | None):
    """Reads the rows of a partition in order. ``min_docs`` None: all but the first occurrence go."""

    def rows_of(kind: np.ndarray, rows: np.ndarray, docs) -> pa.RecordBatch:
        columns = [pa.array(np.broadcast_to(kind, len(rows)).astype(np.int32)), *[pa.array(np.ascontiguousarray(rows[:, i])) for i in range(5)]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.broadcast_to(docs, len(rows)).astype(np.int64))], ["kind", "h1", "h2", "doc_id", "version", "position", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the run of equal hashes which may go on: its rows that are not decided, its documents, its first row
        held: list[np.ndarray] = []
        key, count, last_doc, first, begins = None, 0, None, None, True

        def close(ends: bool) -> Iterator[pa.RecordBatch]:
            """The run is over in this partition; at either edge it may go on elsewhere."""
            if key is None:
                return
            if begins or ends:
                yield rows_of(np.array(EDGE), first[None, :], count)
                if held:
                    yield rows_of(np.array(OPEN), np.concatenate(held), 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([column_of(batch, c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id", "version", "position")], 1)
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            new[0] = key is None or (rows[0, 0], rows[0, 1]) != key
            starts = np.flatnonzero(new)
            bounds = [0, *starts.tolist(), len(rows)] if not new[0] else [*starts.tolist(), len(rows)]
            drop = []
            for a, b in zip(bounds[:-1], bounds[1:]):  # noqa: B905
                if new[a]:
                    yield from close(False)
                    begins = key is None
                    key, count, last_doc, first, held = (rows[a, 0], rows[a, 1]), 0, None, rows[a], []
                    if b < len(rows) and not begins:  # most runs: whole, inside this batch
                        run_rows = rows[a:b]
                        if min_docs is None:
                            if b - a > 1:
                                drop.append(run_rows[1:])
                        elif b - a >= min_docs and 1 + np.count_nonzero(np.diff(run_rows[:, 2])) >= min_docs:
                            drop.append(run_rows)
                        continue
                part = rows[a:b]
                fresh = part[:, 2] != np.concatenate([[part[0, 2] - 1 if last_doc is None else last_doc], part[:-1, 2]])
                total = count + int(fresh.sum())
                if min_docs is None:
                    if last_doc is None:
                        held = [part[:1]]
                        part = part[1:]
                    if len(part):
                        drop.append(part)
                elif total >= min_docs:
                    drop += [*held, part]
                    held = []
                else:
                    held.append(part)
                count, last_doc = total, rows[b - 1, 2]
            if drop:
                yield rows_of(np.array(DROP), np.concatenate(drop), 0)
        yield from close(True)

    return run


def dropped_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """doc_id, version, position of the lines to drop."""
    hashes = line_hashes(docs).where("doc_id is not null")
    ranged = hashes.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "version", "position")
    found = stored_copy(ranged.mapInArrow(_stream(min_docs), FOUND), "lines")
    edges = found.where(F.col("kind") == EDGE)
    still = found.where(F.col("kind") == OPEN)
    if min_docs is None:
        firsts = edges.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "version", "position")).alias("one"))
        late = still.join(firsts, ["h1", "h2"]).where(F.struct("doc_id", "version", "position") != F.col("one"))
    else:
        often = edges.groupBy("h1", "h2").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
        late = still.join(often, ["h1", "h2"], "left_semi")
    names = ["doc_id", "version", "position"]
    return found.where(F.col("kind") == DROP).select(names).unionByName(late.select(names))


def keep_bitmaps(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """doc_id, version (hash of the text), n_dropped, keep: a compressed bitmap, one bit a line.

    ``min_docs`` None keeps the first occurrence of each key, by document and position;
    a number drops the lines whose key that many documents have. Documents that keep all
    their lines have no row. Lines without a key stay. Rows with a null doc_id stay whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, n = [], []
            for value in column_of(batch, "positions"):
                gone = np.unique(np.asarray(value.values.to_numpy(zero_copy_only=False)))
                bits = np.ones(int(gone[-1]) // 8 * 8 + 8, np.uint8)  # lines after these stay
                bits[gone] = 0
                maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
                n.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), column_of(batch, "version"), pa.array(n, pa.int64()), pa.array(maps, pa.binary())],
                ["doc_id", "version", "n_dropped", "keep"],
            )

    gone = dropped_lines(docs, min_docs).groupBy("doc_id", "version").agg(F.collect_list("position").alias("positions"))
    return gone.mapInArrow(run, "doc_id long, version long, n_dropped long, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[list[bytes], int]:
    """The lines that a bitmap keeps and the number of all lines."""
    lines = text.encode("utf-8").split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).tolist()
    bits = bits[: len(lines)] + [1] * (len(lines) - len(bits))
    return [x for x, b in zip(lines, bits, strict=True) if b], len(lines)


def _with_maps(docs: DataFrame, maps: DataFrame) -> DataFrame:
    return docs.join(maps.select("doc_id", "version", "keep"), ["doc_id", "version"], "left")


def line_digests(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays, joined by line feeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps = column_of(batch, "text"), column_of(batch, "keep")
            n, gone, digest = [], [], []
            for i in range(batch.num_rows):
                lines, total = kept_lines(texts[i].as_py(), maps[i].as_py())
                n.append(total)
                gone.append(total - len(lines))
                digest.append(hashlib.sha256(b"\n".join(lines)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    rows = _with_maps(_keyed(docs), keep_bitmaps(docs, min_docs))
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """``docs`` with the lines of the bitmaps taken out of ``text``; all other columns as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps = column_of(batch, "text"), column_of(batch, "_keep")
            new = []
            for i in range(batch.num_rows):
                text, keep = texts[i].as_py(), maps[i].as_py()
                new.append(text if keep is None else b"\n".join(kept_lines(text, keep)[0]).decode("utf-8"))
            columns = [pa.array(new, pa.string()) if c == "text" else column_of(batch, c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    maps = keep_bitmaps(docs, min_docs).select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("keep").alias("_keep"))
    on = (docs["doc_id"].cast("long") == maps["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == maps["_version"])
    rows = docs.join(maps, on, "left").select(*[docs[c] for c in names], "_keep")
    return rows.mapInArrow(run, docs.schema)
