"""Arrow batches as byte arrays: the small helpers which the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together, so that the work arrays stay small.
CHUNK = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``most`` bytes of text, or one row where it is longer."""
    for batch in batches:
        data, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
            end = min(rows, max(end, start + 1))
            yield batch.slice(start, end - start), data[at[start] : at[end]], at[start : end + 1] - at[start]
            start = end


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


def lower_table() -> np.ndarray:
    """A-Z to a-z, every other byte to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run ends where its row ends."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[at] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        row = np.full(max(n, CHUNK + 1), base, np.uint64)
        row[0] = 1
        _powers[base] = np.multiply.accumulate(row)
    return _powers[base][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: differences of one running polynomial sum."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_BASE, n), out=total[1:])
    value = (total[ends] - total[starts]) * _power(_INVERSE, n + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
