"""Repair of damaged conversations with the fewest edits, by divide and conquer.

A repaired conversation has the roles (system)? (user assistant)+, or no row at all. Four states
say how far that is: nothing yet, after the system, after the user, after the assistant. A row is
kept, given the other role, or deleted, and empty rows may be put in before it; so a row is a
small table of the costs from state to state. Costs run forward from the first row and backward
from the last as vectors of four states, and meet in the middle: the best crossing there splits
the conversation in two, each half with fixed ends, and so on down to single rows. Only two
vectors are held beside one byte a row.

Of equally cheap edits those whose letters (K, R, D, I) come first in ASCII order are taken. For that
a forward vector also ranks its states by their least strings of letters. Strings of different
states end with the letter of the same row, so none is the beginning of another, and of
several best crossings the one of the least rank leads to the least string.

The same step works on blocks. Rows are sorted over range partitions, so that a conversation of any
length is cut into consecutive blocks, and each task makes the table of its block. The tables of
a conversation, one for each of its blocks, meet first; then every block is solved between the
states found for its ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homegrid.llm.arrow import column_of
from homegrid.session import stored_copy

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED_COST = 3
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of conversations in one block, on average.
BLOCK = 1 << 20

#: One byte a row: its role's state in the low bits (0 for other roles), its fault above.
FINE, MUST_GO, CUT_SHORT = 0, 4, 8
END = 12

#: Role that a row put in or given another role has in each state, and the state after it.
FOLLOWING = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), ASSISTANT: (USER, "user"), USER: (ASSISTANT, "assistant")}

Entry = tuple[int, object]  # cost, and what orders the strings from one state
Table = Sequence[Sequence[Entry | None]]
Vector = tuple[Entry | None, ...]


@cache
def row_table(code: int) -> Table:
    """Costs and letters of one row, rows put in before it among them; ``END`` stands behind the last."""
    table: list[list[Entry | None]] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state, cost, letters = start, 0, ""
        for _ in range(3):
            if code == END:
                moves = [(NOTHING, 0, "")] if state in (NOTHING, ASSISTANT) else []
            else:
                moves = [(state, DELETE, "D")]
                if code < MUST_GO or code >= CUT_SHORT:
                    extra = TRUNCATED_COST if code >= CUT_SHORT else 0
                    target = FOLLOWING[state][0]
                    moves.append((target, REROLE + extra, "R"))
                    role = code & 3
                    if role == target or (role == SYSTEM and state == NOTHING):
                        moves.append((role, KEEP + extra, "K"))
            for target, price, letter in moves:
                entry = (cost + price, letters + letter)
                if table[start][target] is None or entry < table[start][target]:
                    table[start][target] = entry
            state, cost, letters = FOLLOWING[state][0], cost + INSERT, letters + "I"
    return table


def unit(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


def forward(vector: Vector, table: Table) -> Vector:
    """Least cost of every state after the step, and the rank of its least string."""
    best: list = [None] * 4
    for source, reached in enumerate(vector):
        if reached is None:
            continue
        for target, entry in enumerate(table[source]):
            if entry is not None:
                found = (reached[0] + entry[0], (reached[1], entry[1]))
                if best[target] is None or found < best[target]:
                    best[target] = found
    order = sorted(b[1] for b in best if b is not None)
    return tuple(None if b is None else (b[0], order.index(b[1])) for b in best)


def backward(costs: tuple, table: Table) -> tuple:
    """Least cost from every state before the step to the end; None where there is no way."""
    out = []
    for row in table:
        ways = [e[0] + c for e, c in zip(row, costs, strict=True) if e is not None and c is not None]
        out.append(min(ways) if ways else None)
    return tuple(out)


def crossing(ahead: Vector, behind: tuple) -> int:
    """The state of the cheapest way through the middle; of several that of the least string."""
    ways = [(a[0] + b, a[1], s) for s, (a, b) in enumerate(zip(ahead, behind, strict=True)) if a is not None and b is not None]
    return min(ways)[2]


def _shifted(vector: tuple) -> tuple[int, tuple]:
    """A vector less its smallest cost, so that only a few different ones are ever met."""
    if isinstance(next(v for v in vector if v is not None), tuple):
        least = min(v[0] for v in vector if v is not None)
        return least, tuple(None if v is None else (v[0] - least, v[1]) for v in vector)
    least = min(v for v in vector if v is not None)
    return least, tuple(None if v is None else v - least for v in vector)


@lru_cache(maxsize=100_000)
def _row_forward(vector: Vector, code: int) -> tuple[int, Vector]:
    return _shifted(forward(vector, row_table(code)))


@lru_cache(maxsize=100_000)
def _row_backward(costs: tuple, code: int) -> tuple[int, tuple]:
    return _shifted(backward(costs, row_table(code)))


def rows_forward(codes: bytes, vector: Vector) -> Vector:
    total = 0
    for code in codes:
        least, vector = _row_forward(vector, code)
        total += least
    return tuple(None if v is None else (v[0] + total, v[1]) for v in vector)


def rows_backward(codes: bytes, costs: tuple) -> tuple:
    for code in reversed(codes):
        costs = _row_backward(costs, code)[1]
    return costs


def only(state: int) -> tuple:
    return tuple(0 if s == state else None for s in range(4))


def solve_rows(codes: bytes, start: int, end: int) -> str:
    """Letters of the cheapest, then ASCII-least, way through the rows between two states."""
    out, todo = [], [(0, len(codes), start, end)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low == 1:
            out.append(row_table(codes[low])[a][b][1])
        elif high > low:
            middle = (low + high) // 2
            state = crossing(rows_forward(codes[low:middle], unit(a)), rows_backward(codes[middle:high], only(b)))
            todo += [(middle, high, state, b), (low, middle, a, state)]
    return "".join(out)


def solve_blocks(tables: Sequence[Table], start: int, end: int) -> list[tuple[int, int]]:
    """States at both ends of every block on the best way, by the same meeting in the middle."""
    if len(tables) == 1:
        return [(start, end)]
    middle = len(tables) // 2
    ahead, behind = unit(start), only(end)
    for table in tables[:middle]:
        ahead = forward(ahead, table)
    for table in reversed(tables[middle:]):
        behind = backward(behind, table)
    state = crossing(ahead, behind)
    return solve_blocks(tables[:middle], start, state) + solve_blocks(tables[middle:], state, end)


@lru_cache(maxsize=20_000)
def _short_table(codes: bytes) -> tuple:
    return tuple(rows_forward(codes, unit(state)) for state in range(4))


@lru_cache(maxsize=20_000)
def _short_letters(codes: bytes, start: int, end: int) -> str:
    return solve_rows(codes, start, end)


def block_table(codes: bytes) -> Table:
    return _short_table(codes) if len(codes) <= 64 else tuple(rows_forward(codes, unit(state)) for state in range(4))


def block_letters(codes: bytes, start: int, end: int) -> str:
    return _short_letters(codes, start, end) if len(codes) <= 64 else solve_rows(codes, start, end)


def illegal_pairs(codes: bytes) -> int:
    """Neighbours whose roles' initials are not su, ua or au."""
    role = np.frombuffer(codes, np.uint8) & 3
    pair = role[:-1] * 4 + role[1:]
    return int(np.count_nonzero((pair != SYSTEM * 4 + USER) & (pair != USER * 4 + ASSISTANT) & (pair != ASSISTANT * 4 + USER)))


def repaired_rows(letters: str, rows: Iterator[tuple[int, str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of every row that the letters leave or make; rows are (role's state, role, text)."""
    state = NOTHING
    for letter in letters:
        if letter == "I":
            state, role = FOLLOWING[state]
            yield role, ""
            continue
        kind, role, text = next(rows)
        if letter == "K":
            state = kind
            yield role, text
        elif letter == "R":
            state, role = FOLLOWING[state]
            yield role, text


# -- on Spark ----------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, place, role, text and copies of the rows that are left after the damage.

    The CRC-32 of ``conv_id:turn`` modulo 20 says what befalls a row: 0 drops it, 1 empties its text,
    2 takes its full stops, marks of exclamation and of question, 3 puts it there twice, 4 makes it
    the user's. Nulls count as one space, in that key, in roles and in texts; a null turn
    stays null in the order. Equal rows are one row with their number in ``copies``; rows of one
    turn are ordered by role and the SHA-256 of their text before the damage (``place``).
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(named.cast("binary")), F.lit(20))
    return (
        rows.withColumns({"kind": kind, "place": F.struct("role", F.sha2("text", 256).alias("text_hash"))})
        .where("kind <> 0")
        .select(
            "conv_id", "turn", "place", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("kind") == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies"),
        )
    )


def _role_state(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NOTHING)


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, place, copies, ``state`` of the role and ``fault`` of each row's first copy.

    Blank: no sign but white space. Duplicate: role and text are those of an earlier row. Cut short:
    the last sign is no full stop, mark of exclamation or question. The first row of each role
    and text is found by a minimum, which combines before the shuffle, and joined back by the
    row's own place, so that neither a long conversation nor a text said by all meets in one task.
    """
    said = F.rtrim("text", F.lit(BLANKS))
    own = rows.select(
        "conv_id", "turn", "place", "copies", "role", F.sha2("text", 256).alias("said"), _role_state(F.col("role")).alias("state"),
        F.when(said == "", "blank").when(~F.substring(said, -1, 1).isin(".", "!", "?"), "truncated").alias("look"),
    )
    first = own.groupBy("conv_id", "role", "said").agg(F.min(F.struct("turn", "place")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("first.turn").alias("t"), F.col("first.place").alias("p"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p"))
    # one turn may say one thing by two rows only if their texts differed before the damage
    fault = F.when(F.col("look") == "blank", "blank").when(F.col("p").isNull(), "duplicate").otherwise(F.col("look"))
    return own.join(first, same, "left").select("conv_id", "turn", "place", "copies", "state", fault.alias("fault"))


def _counts(faults: DataFrame) -> DataFrame:
    fault, copies = F.col("fault"), F.col("copies")
    again = F.when(fault.isNull() | (fault == "truncated"), copies - 1).when(fault == "duplicate", copies).otherwise(0)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return faults.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"),
        F.sum(F.when(fault == "blank", copies).otherwise(0)).alias("blank"),
        F.sum(again).alias("duplicate"),
        F.sum(F.when(fault == "truncated", 1).otherwise(0)).cast("long").alias("truncated"),
    )


def _runs(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column_of(batch, name).to_pylist() for name in names], strict=True)


def _by_key(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Consecutive rows of one first column; each group is read on before the next is asked for."""
    held: list[tuple] = []

    def group(key) -> Iterator[tuple]:
        while held and held[0][0] == key:
            yield held.pop()
            held.extend([r for r in [next(rows, None)] if r is not None])

    held.extend([r for r in [next(rows, None)] if r is not None])
    while held:
        key = held[0][0]
        yield key, group(key)


def _batched(rows: Iterator[tuple], names: Sequence[str], kinds: Sequence[pa.DataType], size: int = 500) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], list(names))

    for row in rows:
        done.append(row)
        if len(done) >= size:
            yield batch()
            done = []
    if done:
        yield batch()


def _blocks(faults: DataFrame, block: int) -> DataFrame:
    """One row for each conversation and range partition: a byte a row, and the table of the block."""
    n_rows = faults.count()
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("place")]
    code = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", CUT_SHORT).otherwise(FINE)
    ordered = (
        faults.withColumn("code", F.col("state") + code)
        .repartitionByRange(int(n_rows // block) + 1, *order).sortWithinPartitions(*order)
        .select("conv_id", "code", "copies", F.spark_partition_id().alias("piece"))
    )
    names = ["conv_id", "piece", "codes", "costs", "ranks"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, rows in _by_key(_runs(batches, ["conv_id", "code", "copies", "piece"])):
                codes, piece = bytearray(), 0
                for _, code, copies, piece in rows:  # noqa: B007
                    codes.append(code)
                    codes += bytes([code & 3 | MUST_GO]) * (copies - 1)
                entries = [e for row in block_table(bytes(codes)) for e in row]
                yield conv, piece, bytes(codes), [None if e is None else e[0] for e in entries], [None if e is None else e[1] for e in entries]

        yield from _batched(found(), names, kinds)

    return ordered.mapInArrow(run, "conv_id long, piece int, codes binary, costs array<long>, ranks array<int>")


def _ends(blocks: DataFrame) -> DataFrame:
    """For every block the states at its ends, and on the first one the cost and illegal pairs at borders."""
    rows = blocks.select("conv_id", "piece", "costs", "ranks", F.substring("codes", 1, 1).alias("first"), F.substring("codes", -1, 1).alias("last"))
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "piece")
    names = ["conv_id", "piece", "start", "end", "cost", "borders", "final"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, group in _by_key(_runs(batches, ["conv_id", "piece", "costs", "ranks", "first", "last"])):
                pieces, tables, edges = [], [], []
                for _, piece, costs, ranks, first, last in group:
                    entries = [None if c is None else (c, r) for c, r in zip(costs, ranks, strict=True)]
                    pieces.append(piece)
                    tables.append([entries[4 * i : 4 * i + 4] for i in range(4)])
                    edges.append((first, last))
                whole = [*tables, row_table(END)]
                vector = unit(NOTHING)
                for table in whole:
                    vector = forward(vector, table)
                borders = sum(illegal_pairs(a[1] + b[0]) for a, b in zip(edges, edges[1:]))  # noqa: B905
                states = solve_blocks(whole, NOTHING, NOTHING)
                for k, piece in enumerate(pieces):
                    own = (vector[NOTHING][0], borders) if k == 0 else (0, 0)
                    yield conv, piece, *states[k], *own, k == len(pieces) - 1

        yield from _batched(found(), names, kinds)

    return ordered.mapInArrow(run, "conv_id long, piece int, start int, end int, cost long, borders long, final boolean")


def _audits(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """Per conversation its letters, their cost, and the number of illegal pairs."""
    c, p = F.col("c"), F.col("p")
    named = ends.withColumnsRenamed({"conv_id": "c", "piece": "p"})
    both = blocks.select("conv_id", "piece", "codes").join(named, F.col("conv_id").eqNullSafe(c) & (F.col("piece") == p))
    names = ["conv_id", "piece", "letters", "cost", "illegal"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, piece, codes, start, end, cost, borders, final in _runs(batches, ["conv_id", "piece", "codes", "start", "end", "cost", "borders", "final"]):
                letters = block_letters(codes, start, end)
                if final:
                    letters += row_table(END)[end][NOTHING][1]
                yield conv, piece, letters, cost, borders + illegal_pairs(codes)

        yield from _batched(found(), names, kinds)

    solved = both.mapInArrow(run, "conv_id long, piece int, letters string, cost long, illegal long")
    pieces = F.array_sort(F.collect_list(F.struct("piece", "letters")))
    return solved.groupBy("conv_id").agg(
        F.array_join(pieces["letters"], "").alias("audit"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal")
    )


def repair(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position, role and text of the repaired rows, in order within each conversation.

    A conversation's letters come first in its partition and its rows after them in order; one row
    is held at a time.
    """
    first = audits.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast(rows.schema["place"].dataType).alias("place"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"), F.lit(0).alias("state"))
    rest = rows.select("conv_id", F.lit(1).alias("part"), "turn", "place", "role", "text", "copies", _role_state(F.col("role")).alias("state"))
    order = [F.asc_nulls_first("conv_id"), F.asc("part"), F.asc_nulls_first("turn"), F.asc_nulls_first("place")]
    ordered = first.unionByName(rest).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, group in _by_key(_runs(batches, ["conv_id", "state", "role", "text", "copies"])):
                letters = next(group)[3]
                copies = ((state, role, text) for _, state, role, text, n in group for _ in range(n))
                for position, (role, text) in enumerate(repaired_rows(letters, copies)):
                    yield conv, position, role, text
                for _ in copies:  # rows deleted at the end have been read; this ends the group
                    pass

        yield from _batched(found(), ["conv_id", "position", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()])

    return ordered.select("conv_id", "state", "role", "text", "copies").mapInArrow(run, "conv_id long, position long, role string, text string")


def _hashes(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines; runs along the rows in the order that ``repair`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, group in _by_key(_runs(batches, ["conv_id", "position", "role", "text"])):
                digest = hashlib.sha256()
                for _, position, role, text in group:
                    digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
                yield conv, digest.hexdigest()

        yield from _batched(found(), ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()])

    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_rows(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts, audits and repaired rows of conversations given as by :func:`damage`.

    Rows have conv_id, turn, place, role, text and copies. Their texts and the byte a row of each
    block are stored in the shared folder, so a lost executor repeats a stage at most. A null
    conv_id is one conversation. ``block`` is the number of rows of a range partition.
    """
    rows = stored_copy(rows, "rows")
    faults = stored_copy(with_faults(rows), "faults")
    blocks = stored_copy(_blocks(faults, block), "blocks")
    audits = stored_copy(_audits(blocks, _ends(blocks)), "audits")
    return _counts(faults), audits, repair(rows, audits)


def repair_digests(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of the given table, a null conv_id among them: faults, edits, hash.

    Conversations that lost all rows have zeros, no edits and the hash of nothing; an empty table
    gives no rows; repeated rows count as often as they are there; further columns are left out.
    Edits of a conversation are one string and its hash is sequential, so the last pass
    reads one conversation in one task, a row at a time; all before it works by block.
    """
    counts, audits, repaired = repair_rows(damage(conversations), block)
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for side in (counts, audits, _hashes(repaired)):
        named = side.withColumnRenamed("conv_id", "c")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
