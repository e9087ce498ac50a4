"""Fill-in-the-middle transformation by block rotation in place.

One scan of a text's bytes finds its units (a run of A-Z and a-z, or any other code point) and so
where the two cuts lie. The text goes into a bytearray with the marks of prefix, middle and suffix
put in at the cuts, in reading order. Segments are then exchanged by a rotation, which is three
reversals in place: one rotation of the last two segments gives prefix, suffix, middle; one of the
whole gives suffix, prefix, middle. The inverse rotation brings the reading order back, and
without its marks the row is the text again, byte by byte.

A mark can't arise by accident: each begins with a sign that no mark has elsewhere, and texts
that hold a mark stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homegrid.llm.arrow import byte_set, chunks, column_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
LETTERS = byte_set(bytes([*range(65, 91), *range(97, 123)]))
#: Bytes that a reversal exchanges at a time.
SWAP = 1 << 16


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte positions at which the units of UTF-8 ``data`` begin."""
    letter = LETTERS[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def reverse(row: np.ndarray) -> None:
    """Turns a view round in place, exchanging blocks from both ends."""
    left, right = 0, len(row)
    while right - left > 1:
        k = min(SWAP, (right - left) // 2)
        head = row[left : left + k].copy()
        row[left : left + k] = row[right - k : right][::-1]
        row[right - k : right] = head[::-1]
        left, right = left + k, right - k


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchanges the neighbours start..cut and cut..end of the buffer by three reversals."""
    row = np.frombuffer(buffer, np.uint8)
    reverse(row[start:cut])
    reverse(row[cut:end])
    reverse(row[start:end])


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with marks, cut at two byte positions, in the order of ``form``."""
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytes:
    """The text behind an output, from the output and its form alone."""
    if form == PLAIN:
        return bytes(output)
    buffer = bytearray(output)
    if form == PSM:
        start, cut = buffer.index(SUFFIX), buffer.index(MIDDLE)
    else:
        start, cut = 0, buffer.index(PREFIX)
    rotate(buffer, start, cut, len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _draws(seed: str, id_col: str) -> list[Column]:
    """Four unsigned numbers from the SHA-256 of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, seed: str = "1", percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every text.

    ``percent`` of the texts are rearranged, ``spm_percent`` of these with the suffix in front; what
    happens to a text hangs on seed and id alone. A null text is empty; empty texts, and those
    that hold a mark, are plain, with null counts of letters. Repeated rows give a row each, rows of
    one id the same draws; an empty table gives no rows; further columns are left out. A task holds
    one text of any length, or about 1 MiB of short ones, at a time.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *_draws(seed, "doc_id"))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches):
            draws = [column_of(part, f"h{i}").to_pylist() for i in (1, 2, 3, 4)]
            out = []
            for i, (h1, h2, h3, h4) in enumerate(zip(*draws, strict=True)):
                row = data[at[i] : at[i + 1]]
                text = row.tobytes()
                starts = unit_starts(row)
                n = len(starts)
                if n == 0 or h3 % 100 >= percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                    out.append((n, PLAIN, None, None, text.decode()))
                    continue
                edges = np.append(starts, len(text))
                first, second = (int(edges[k]) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                form = SPM if h4 % 100 < spm_percent else PSM
                lengths = [int(np.count_nonzero((x & 0xC0) != 0x80)) for x in (row[:first], row[first:second])]
                out.append((n, form, *lengths, arrange(text, first, second, form).decode()))
            columns = [pa.array([r[k] for r in out], kinds[k + 1]) for k in range(5)]
            yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` (any columns, output and form among them) with ``restored``, the text behind the output."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "output"):
            forms = column_of(part, "form").to_pylist()
            texts = [restore(data[at[i] : at[i + 1]].tobytes(), form).decode() for i, form in enumerate(forms)]
            yield part.append_column("restored", pa.array(texts, pa.string()))

    return rows.drop("restored").mapInArrow(run, f"{fields}, restored string")


def fim_digests(rows: DataFrame) -> DataFrame:
    """Hashes in place of the texts of ``restored``'s rows."""
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
