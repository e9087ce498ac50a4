"""Token files, fill-in-the-middle and the repair of conversations."""

import functools
import hashlib
import io
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from homegrid.llm import bpe, fim, queries, repair, tokenfile
from homegrid.session import shared_dir
from tests.conftest import SMALL

BYTE_BPE = bpe.public_vocabulary("byte_bpe_50k.json")
ODD = [None, "", " ", "a", "\n\n x", "é<|endoftext|>é", "日本語" * 50, "word " * 5000, "<P>", "a<S>b", "x퟿y", "same", "same"]


def library_ids(texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


# -- token files ------------------------------------------------------------------------


def written(lengths, frame):
    rng, sink = np.random.default_rng(4), io.BytesIO()
    rows = [rng.integers(0, 50257, n).astype("<u4") for n in lengths]
    writer = tokenfile.FrameWriter(sink, pa.int64(), frame)
    for i, row in enumerate(rows):
        writer.add(10 * i, row)
    writer.close()
    return rows, sink.getvalue()


@pytest.mark.parametrize("frame", [1, 7, 64, 1000])
def test_a_file_reads_back_by_document(frame):
    rows, data = written([1, 0, 5, 64, 63, 200, 1], frame)
    reader = tokenfile.FrameReader(io.BytesIO(data))
    assert reader.ids.to_pylist() == [0, 10, 20, 30, 40, 50, 60]
    for k in random.Random(1).sample(range(7), 7):
        assert reader.document(k) == rows[k].tobytes()


def test_any_zstandard_reader_gets_the_stream():
    rows, data = written([10, 300, 4], 32)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(r.tobytes() for r in rows)


def test_only_wanted_frames_are_opened():
    _, data = written([50] * 100, 100)
    reader = tokenfile.FrameReader(io.BytesIO(data))
    assert len(reader.plain) == 50 and reader.frames_read == 0
    reader.document(31)
    assert reader.frames_read == 1


def test_damage_is_found():
    _, data = written([50] * 20, 100)
    reader = tokenfile.FrameReader(io.BytesIO(data))
    inside = int(reader.offsets[3]) + 40
    broken = data[:inside] + bytes([data[inside] ^ 1]) + data[inside + 1 :]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfile.FrameReader(io.BytesIO(broken)).frame(3)
    for cut in (data[:-1], data[:-9] + b"x" * 9):
        with pytest.raises(ValueError):
            tokenfile.FrameReader(io.BytesIO(cut))
    directory = int(reader.offsets[-2]) + 20
    with pytest.raises(ValueError):
        tokenfile.FrameReader(io.BytesIO(data[:directory] + bytes([data[directory] ^ 1]) + data[directory + 1 :]))


def ids_of(encoder, texts):
    rows = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    return [row.tolist() for row in encoder.encode(np.frombuffer(b"".join(rows), np.uint8), at)]


@pytest.mark.parametrize("chunk", [1, 90, 1 << 20])
def test_cached_words_give_the_ids_of_the_library(monkeypatch, chunk):
    monkeypatch.setattr(tokenfile, "CACHE", 40)
    monkeypatch.setattr(tokenfile, "LONGEST", 6)
    monkeypatch.setattr(tokenfile, "BLOCK", chunk)
    common = ["a", "Bc", "the", " ", "  ", "\n", "\r\n", "'s", "'", "9", "12", "é", "ß", "!", "...", "\t", "日", "ⅷ", "²", "\u0308", "😀", "\x00"]
    rare = ["\x1c", "\x85", "\xa0", "\u2003", "\u180e", "\u200b", "\ufeff", "\u3000", "<|endoftext|>"]
    tokenizer, rng, texts = Tokenizer.from_file(BYTE_BPE), random.Random(6), []
    for i in range(1500):
        signs = common + rare if i % 7 == 0 else common
        texts.append("".join(rng.choice(signs) for _ in range(rng.randrange(60))))
    encoder = tokenfile.Encoder(BYTE_BPE)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for at in range(0, len(texts), 100):
        assert ids_of(encoder, texts[at : at + 100]) == want[at : at + 100]
    assert ids_of(encoder, []) == [] and ids_of(encoder, ["", ""]) == [[], []]


def test_other_vocabularies_go_through_the_library():
    path, texts = bpe.public_vocabulary(), ["Some Words\n here", "", "é  x"]
    tokenizer = Tokenizer.from_file(path)
    assert ids_of(tokenfile.Encoder(path), texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_of_odd_rows(spark, documents):
    rows = [(None, "null id"), (None, "null id"), *enumerate(ODD), (3, "second of its id")]
    folder = shared_dir(spark, "tokens")
    manifest = tokenfile.write_tokens(documents(rows), folder, BYTE_BPE, shard=4000, frame=100)
    assert manifest.count() > 3
    got = [tuple(r) for r in tokenfile.read_tokens(spark, folder).orderBy("start").collect()]
    order = sorted(got, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in got] == [r[0] for r in order]
    want = [(i, ids.tobytes()) for (i, _), ids in zip(rows, library_ids([t for _, t in rows]))]
    assert sorted(((r[0], bytes(r[3])) for r in got), key=str) == sorted(want, key=str)
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]


def test_wanted_documents_only(spark, documents):
    folder = shared_dir(spark, "tokens")
    tokenfile.write_tokens(documents([(i, f"text {i} " * 20) for i in range(200)]), folder, BYTE_BPE, shard=2000, frame=64)
    whole = {r.doc_id: tuple(r) for r in tokenfile.read_tokens(spark, folder).collect()}
    some = tokenfile.read_tokens(spark, folder, [7, 150, 999])
    assert {r.doc_id: tuple(r) for r in some.collect()} == {i: whole[i] for i in (7, 150)}
    named = spark.createDataFrame([("b", "two"), ("a", "one")], "doc_id string, text string")
    other = shared_dir(spark, "tokens")
    tokenfile.write_tokens(named, other, BYTE_BPE)
    assert [r.doc_id for r in tokenfile.read_tokens(spark, other).orderBy("start").collect()] == ["a", "b"]


def test_files_of_lost_attempts_are_not_read(spark, documents):
    folder = shared_dir(spark, "tokens")
    tokenfile.write_tokens(documents([(1, "one"), (2, "two")]), folder, BYTE_BPE)
    files = f"{folder.removeprefix('file://')}/files"
    with open(f"{files}/000000-lost.zst", "wb") as f:
        f.write(b"half a file")
    assert len(os.listdir(files)) == 2 and tokenfile.read_tokens(spark, folder).count() == 2


def test_empty_table_of_tokens(spark, documents):
    folder = shared_dir(spark, "tokens")
    assert tokenfile.write_tokens(documents([]), folder, BYTE_BPE).count() == 0
    assert tokenfile.read_tokens(spark, folder).count() == 0


def test_token_query_equals_the_library(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()
    want, at = {}, 0
    for (doc, _), ids in zip(docs, library_ids([t for _, t in docs])):
        want[doc] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op11_token_files(spark, SMALL).collect()}
    assert got == want


# -- fill in the middle -----------------------------------------------------------------


def fim_by_hand(doc_id, text):
    """The contract word by word, on strings."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("swap", [1, 3, 1 << 16])
def test_rotation_exchanges_neighbours(monkeypatch, swap):
    monkeypatch.setattr(fim, "SWAP", swap)
    rng = random.Random(2)
    for _ in range(200):
        row = bytes(rng.randrange(256) for _ in range(rng.randrange(40)))
        start, cut, end = sorted(rng.randrange(len(row) + 1) for _ in range(3))
        buffer = bytearray(row)
        fim.rotate(buffer, start, cut, end)
        assert buffer == row[:start] + row[cut:end] + row[start:cut] + row[end:]


def test_marks_are_found_among_signs_like_them():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("<PSM>a") for _ in range(rng.randrange(12))).encode()
        if any(m in text for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
            continue
        a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
        for form in (fim.PSM, fim.SPM):
            assert fim.restore(bytes(fim.arrange(text, a, b, form)), form) == text


def test_fim_of_odd_rows(spark, documents):
    long = "lange Wörter, ünd\t" * 90_000
    rows = [(None, "no id at all"), *enumerate(ODD * 4), (500, long), (3, "same id"), (3, "same id")]
    got = fim.restored(fim.transform(documents(rows))).collect()
    want = [(i, *fim_by_hand("" if i is None else i, t)) for i, t in rows]
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == sorted(want, key=str)
    assert sorted((r.restored for r in got), key=str) == sorted((t or "" for _, t in rows), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.restored(fim.transform(documents([]))).count() == 0


def test_fim_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op12_fill_in_middle"]).fetchall())
    assert sorted(map(tuple, queries.op12_fill_in_middle(spark, SMALL).collect())) == want


# -- repair of conversations ------------------------------------------------------------


def cheapest(codes):
    """Every sequence of edits tried: cost and letters of the cheapest, then least."""

    @functools.cache
    def go(i, state, put_in):
        ways = []
        target = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        if i == len(codes):
            ways += [(0, "")] if state in (0, 3) else []
        else:
            moves = [(4, "D", state)]
            if codes[i] // 4 != 1:
                more = 3 if codes[i] // 4 == 2 else 0
                moves.append((3 + more, "R", target))
                if codes[i] % 4 == target or (codes[i] % 4, state) == (1, 0):
                    moves.append((more, "K", codes[i] % 4))
            ways += [(c + go(i + 1, s, 0)[0], x + go(i + 1, s, 0)[1]) for c, x, s in moves if go(i + 1, s, 0)]
        if put_in < 3 and (rest := go(i, target, put_in + 1)):
            ways.append((3 + rest[0], "I" + rest[1]))
        return min(ways, default=None)

    return go(0, 0, 0)


def test_meeting_in_the_middle_finds_the_least_letters():
    rng = random.Random(1)
    for _ in range(1500):
        codes = tuple(rng.randrange(12) for _ in range(rng.randrange(9)))
        cost, letters = cheapest(codes)
        whole = bytes([*codes, repair.END])
        assert repair.solve_rows(whole, 0, 0) == letters
        assert repair.rows_forward(whole, repair.unit(0))[0][0] == cost


def test_blocks_meet_like_rows():
    rng = random.Random(2)
    for _ in range(300):
        codes = bytes(rng.randrange(12) for _ in range(rng.randrange(1, 60)))
        cuts = sorted({0, len(codes), *(rng.randrange(len(codes)) for _ in range(rng.randrange(6)))})
        parts = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        ends = repair.solve_blocks([*map(repair.block_table, parts), repair.row_table(repair.END)], 0, 0)
        letters = "".join(repair.block_letters(p, a, b) for p, (a, b) in zip(parts, ends))
        letters += repair.solve_rows(bytes([repair.END]), *ends[-1])
        assert letters == repair.solve_rows(codes + bytes([repair.END]), 0, 0) == cheapest(codes)[1]


def by_hand(rows):
    """The contract for the rows of one conversation, as (conv_id, turn, role, text)."""
    left = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest())
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        left += [(place, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    left.sort(key=lambda r: r[0])
    seen, codes, faults = set(), [], []
    for _, _, role, text in left:
        signs = re.sub("[\\x20\\x09-\\x0D]", "", text)
        fault = "blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        codes.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + {"": 0, "truncated": 8}.get(fault, 4))
    cost, audit = cheapest(tuple(codes))
    said, at, first = [], 0, None
    for letter in audit:
        role, text = ("", "") if letter == "I" else left[at][2:]
        at += letter != "I"
        if letter != "D":
            first = first or (letter, role[:1])
            turn_of = "user" if (len(said) - (first == ("K", "s"))) % 2 == 0 else "assistant"
            said.append(f"{role if letter == 'K' else turn_of}:{text}")
    turns = {t for _, t, _, _ in left if t is not None}
    roles = [r[2][:1] for r in left]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_repair_of_odd_conversations(spark, block):
    rng = random.Random(7)
    texts = ["One.", "Two?", "no end", "end. \n", "", " \t", None, "One.", "a" * 50_000 + "!"]
    rows = []
    for conv in [*range(30), None]:
        for _ in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 4, 5, 9]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys"]), rng.choice(texts)))
    rows += [(99, t, ("user", "assistant")[t % 2], f"text {t % 40}.") for t in range(120)]
    rows += [(98, 5, "user", "again and again.")] * 25
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, copies int").repartition(4)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_digests(df, block).collect()}
    assert got == {conv: by_hand([r for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert repair.repair_digests(df.limit(0)).count() == 0


def test_repair_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    want = sorted(con.execute(f"select {names} from ({queries.ORACLE_SQL['op13_repair_conversations']})").fetchall())
    assert sorted(map(tuple, queries.op13_repair_conversations(spark, SMALL).select(*names.split(", ")).collect())) == want
