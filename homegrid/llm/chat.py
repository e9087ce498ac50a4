"""Chat formatting from an event log.

A conversation is a log of events: parts of a message as they were streamed (``delta``),
replacements of its text (``edit``) and new attempts (``regenerate``, after which its text
begins anew). The log is partitioned by conversation and sorted by message and sequence; one
pass folds the events of each message into its final text and renders it. A task holds one
message at a time, however long the conversation.

A turn is ``[INST]role[/INST]text</s>``. Inside roles and texts the first signs of these control
strings, and the escape sign, are written as the escape sign and a letter, so that no text can
end a turn and every rendered conversation reads back to the same roles and texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from homegrid.llm.arrow import column_of

BEGIN, MIDDLE, END = "[INST]", "[/INST]", "</s>\n"
ESCAPE = "\\"
EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"
RENDERED = "conv_id long, message long, formatted string, loss_start long, loss_end long"


LETTERS = {ESCAPE: "e", "[": "b", "<": "l"}
SIGNS = {letter: sign for sign, letter in LETTERS.items()}


def escape(text: str) -> str:
    for sign, letter in LETTERS.items():
        text = text.replace(sign, ESCAPE + letter)
    return text


def unescape(text: str) -> str:
    out, at = [], 0
    while (i := text.find(ESCAPE, at)) >= 0:
        out += [text[at:i], SIGNS[text[i + 1]]]
        at = i + 2
    return "".join([*out, text[at:]])


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and where its text begins and ends in it: the loss mask of an assistant's turn."""
    head = f"{BEGIN}{escape(role)}{MIDDLE}"
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation or a part of it."""
    turns = []
    for part in formatted.split(BEGIN)[1:]:
        role, _, rest = part.partition(MIDDLE)
        if not rest.endswith(END):
            raise ValueError("a turn has no end")
        turns.append((unescape(role), unescape(rest[: -len(END)])))
    return turns


def events_of(rows: DataFrame, size: int = 2000) -> DataFrame:
    """The log behind a table of finished turns (conv_id, turn, role, text): deltas of ``size`` letters.

    A null text is empty and a null role the empty role. Rows that repeat a turn stay turns
    of their own: messages are numbered by turn, role and text.
    """
    known = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = known.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / size).cast("int")), lambda k: F.struct(k.alias("k"), F.substr(F.col("text"), k * size + 1, F.lit(size)).alias("part")))
    one = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return one.select(
        "conv_id", F.col("turn").alias("message"), F.struct("role", F.xxhash64("text").alias("tie"), "copy").alias("tie"), F.explode(pieces).alias("p"), "role"
    ).select("conv_id", "message", "tie", F.col("p.k").cast("long").alias("seq"), F.lit("delta").alias("kind"), "role", F.col("p.part").alias("text"))


def fold(events: Iterator[tuple[str, str | None, str | None]]) -> tuple[str, str]:
    """(kind, role, text) in order to the final role and text of one message."""
    role, parts = "", []
    for kind, who, text in events:
        role = who or role
        if kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts = [text or ""]
        elif kind == "regenerate":
            parts = [text or ""]
        else:
            raise ValueError(f"unknown event {kind}")
    return role, "".join(parts)


def format_conversations(events: DataFrame) -> DataFrame:
    """One row per message, in order within its conversation: the rendered turn and its loss span.

    ``events`` has conv_id, message, seq, kind, role, text and may have ``tie``, which tells
    messages of one number apart. A null kind is a delta; the last role given holds. Loss spans
    are set for the assistant's turns and null for all others. Conversations without events
    give no rows. Nulls in conv_id make one conversation, first in order.
    """
    tie = F.col("tie") if "tie" in events.columns else F.lit(None).cast("string")
    rows = events.select(
        F.col("conv_id").cast("long"), F.col("message").cast("long"), F.to_json(F.struct(tie.alias("t"))).alias("tie"), F.col("seq").cast("long"),
        F.coalesce("kind", F.lit("delta")).alias("kind"), "role", "text",
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "message", "tie", "seq", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def logs() -> Iterator[tuple[tuple, tuple]]:
            for batch in batches:
                columns = [column_of(batch, c).to_pylist() for c in ("conv_id", "message", "tie", "kind", "role", "text")]
                for conv, message, tie_, kind, role, text in zip(*columns, strict=True):
                    yield (conv, message, tie_), (kind, role, text)

        done: list[tuple] = []
        key, held = None, []

        def turn() -> tuple:
            role, text = fold(iter(held))
            formatted, a, b = render(role, text)
            loss = (a, b) if role == "assistant" else (None, None)
            return (key[0], key[1], formatted, *loss)

        def batch_of(rows_: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows_], k) for i, k in enumerate(kinds)], ["conv_id", "message", "formatted", "loss_start", "loss_end"]
            )

        for k, event in logs():
            if key is not None and k != key:
                done.append(turn())
                held = []
                if len(done) >= 500:
                    yield batch_of(done)
                    done = []
            key = k
            held.append(event)
        if key is not None:
            done.append(turn())
        if done:
            yield batch_of(done)

    return ordered.mapInArrow(run, RENDERED)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its rendered turns read back to; needs the order of ``format_conversations``.

    The hashes run along the turns as they come, so a conversation of any length is never held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        key, state, begun = None, None, False

        def row() -> tuple:
            return key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            done = []
            columns = [column_of(batch, c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]
            for conv, text, a, b in zip(*columns, strict=True):
                if not begun or conv != key:
                    if begun:
                        done.append(row())
                    key, state, begun = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                for role, said in read_back(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if a is not None:
                    loss = unescape(text[a:b])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([row()[i]], k) for i, k in enumerate(kinds)], names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
