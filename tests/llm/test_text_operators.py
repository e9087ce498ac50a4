"""Operators on documents against brute force, on small tables and odd rows."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from homegrid.llm import bpe, decontam, jaccard, lines, queries, suffix
from tests.conftest import SMALL

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "One two"), (7, "\n\n"), (8, "É é İ ΟΔΟΣ"),
    (9, "x" * 5000), (10, "a b c " * 3000), (11, "a b c " * 3000), (12, "<|endoftext|> z"), (13, "\x1cq\x85r​s"),
]


@pytest.fixture(scope="module")
def small():
    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()


def lowered(text):
    return text.encode().lower().decode()


# -- byte-pair encoding -----------------------------------------------------------------


def library():
    t = Tokenizer.from_file(bpe.public_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_encoding_equals_the_library():
    mine, theirs, rng = bpe.Bpe(bpe.public_vocabulary()), library(), random.Random(3)
    texts = [t or "" for _, t in ODD] + ["don't I'LL ٣٤ ⅷ x²", "ab'll" * 300, "a" * 399 + " " + "b" * 400]
    for _ in range(500):
        texts.append("".join(chr(rng.choice([rng.randrange(1, 128), rng.randrange(1, 0x3000), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(25)))
    for text in texts:
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == want
        assert mine.decode(mine.encode(text)) == theirs.decode(want, skip_special_tokens=False)


def test_long_words_merge_as_short_ones():
    b, rng = bpe.Bpe(bpe.public_vocabulary()), random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("abeinorst") for _ in range(rng.randrange(1, 60)))
        assert b.merge(b.symbols(word)) == b.merge_long(b.symbols(word))


def test_digests_of_all_documents(spark, small):
    theirs = library()
    got = {r.doc_id: r for r in queries.op1_bpe(spark, SMALL).collect()}
    assert len(got) == len(small)
    for i, text in small:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_gives_ids_and_texts(spark, documents):
    rows = bpe.encode(documents([*ODD, (None, "hello"), (4, "one")]), bpe.public_vocabulary()).collect()
    assert len(rows) == len(ODD) + 2
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3, 7)} == {0}
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert bpe.digests(documents([]), bpe.public_vocabulary()).count() == 0


# -- Jaccard join -----------------------------------------------------------------------


def brute_links(rows, percent, width):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(t or ""))
        n = max(1, len(words) - width + 1)
        sets[i] = frozenset(tuple(words[k : k + width]) for k in range(n)) if words else frozenset()
    near = {i: [] for i in sets}
    items = [(i, s) for i, s in sets.items() if s]
    for k, (i, s) in enumerate(items):
        for j, t in items[:k]:
            if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                c = len(s & t)
                if 100 * c >= percent * (len(s) + len(t) - c):
                    near[i].append(j)
                    near[j].append(i)
    out = {}
    for i in sorted(sets):
        if i not in out:
            todo, found = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in found:
                        found.add(j)
                        todo.append(j)
            out.update(dict.fromkeys(found, i))
    return {i: (i, len(sets[i]), out[i], len(near[i])) for i in sets}


def near_copies(seed, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [rng.choice(words) for _ in range(rng.randrange(3, 90))]
        rows.append((i * 3 + 5, " ".join(text)))
    return rows


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5)])
def test_join_finds_every_link(spark, documents, percent, width, monkeypatch):
    monkeypatch.setattr(jaccard, "RATES", (8, 3, 1))
    monkeypatch.setattr(jaccard, "OWNERS", 4)
    monkeypatch.setattr(jaccard, "MEMBERS", 7)
    rows = near_copies(percent)
    want = brute_links(rows, percent, width)
    assert sum(w[3] for w in want.values()) > 50
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents(rows), percent, width).collect()}
    assert got == want


def test_join_of_odd_rows(spark, documents):
    rows = [*ODD, (20, "one two"), (20, "one two")]
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents([*rows, (None, "one two")])).collect()}
    want = brute_links(dict(rows).items(), 90, 3)
    assert got.pop(None)[2:] == (None, 0)
    assert got == want
    assert got[5] == (5, 1, 5, 2) and got[10][2:] == (10, 1) and got[1] == (1, 0, 1, 0)


def test_join_of_an_empty_table(spark, documents):
    assert jaccard.jaccard_join(documents([])).count() == 0


def test_whole_sets_are_stored_once_and_not_shuffled(spark, documents, monkeypatch):
    seen, size, store = [], "spark.sql.execution.arrow.maxBytesPerBatch", jaccard.stored_copy

    def stored(df, purpose):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append(("hashes" in df.columns, "hashpartitioning" in plan, spark.conf.get(size, None)))
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "stored_copy", stored)
    rows = near_copies(5, 40)
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents([*rows, *rows])).collect()}
    assert got == brute_links(rows, 90, 3)
    assert [dealt for whole, dealt, _ in seen if whole] == [False]
    assert {int(most) for *_, most in seen} == {jaccard.BATCH} and spark.conf.get(size, None) is None


def test_plans_do_not_grow_with_the_levels(spark, documents, monkeypatch):
    reads, store = [], jaccard.stored_copy

    def stored(df, purpose):
        if purpose in ("near", "links"):
            reads.append(df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate"))
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "stored_copy", stored)
    monkeypatch.setattr(jaccard, "RATES", (8, 4, 2, 1))
    assert jaccard.jaccard_join(documents(near_copies(5, 40))).count() == 40
    near = reads[::2]
    assert len(reads) == 8 and max(near) <= near[0]  # before: the levels before were part of each plan


def test_texts_left_by_a_level_are_stored(spark, documents, monkeypatch):
    joins, store = [], jaccard.stored_copy

    def stored(df, purpose):
        if purpose == "near":
            joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "stored_copy", stored)
    monkeypatch.setattr(jaccard, "RATES", (8, 4, 2, 1))
    assert jaccard.jaccard_join(documents(near_copies(5, 40))).count() == 40
    assert max(joins) == joins[0] <= 3  # before: one more for each level wherever its texts are read


def test_texts_that_share_many_shingles_meet_in_one_list(spark, documents, monkeypatch):
    seen, alike, rng = [], jaccard._alike, random.Random(4)

    def counted(lists, *rest):
        out = alike(lists, *rest)
        seen.append([d.selectExpr("sum(size(ps))").first()[0] for d in (lists, out)])
        return out

    monkeypatch.setattr(jaccard, "_alike", counted)
    monkeypatch.setattr(jaccard, "RATES", (1,))
    rows = []
    for i in range(0, 60, 2):
        words = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:100], "changed", *words[101:]]))]
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents(rows)).collect()}
    assert got == brute_links(rows, 90, 3) and all(r[3] == 1 for r in got.values())
    ((before, after),) = seen
    assert before > 10 * 60 and after == 60  # before: one row for each list and text


@pytest.mark.parametrize("changes", [4, 7])  # two copies are mostly within 2 EPS, or between 2 and 3 EPS
def test_big_groups_of_near_copies_meet_few_pivots(spark, documents, changes, monkeypatch):
    pairs, store, rng = [], jaccard.stored_copy, random.Random(changes)

    def stored(df, purpose):
        out = store(df, purpose)
        pairs.extend([out.where("x <> p").count()] if purpose == "distances" else [])
        return out

    monkeypatch.setattr(jaccard, "stored_copy", stored)
    monkeypatch.setattr(jaccard, "RATES", (4, 1))
    monkeypatch.setattr(jaccard, "PIVOTS", 4, raising=False)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(200):
        text = rows[-1][1].split() if i % 2 else list(base)  # every second one is a close copy of the one before
        for k in rng.sample(range(120), 1 if i % 2 else changes):
            text[k] = f"c{rng.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents(rows), 80, 3).collect()}
    assert got == brute_links(rows, 80, 3)
    assert sum(pairs[:-1]) < 12 * len(rows)  # before: some 50 pivots, and each met every text


def test_postings_of_pivots_only(spark):
    rest = spark.createDataFrame([(1, 10, [5, 6, 7, 8]), (2, 4, [6, 9])], "node long, n long, first array<long>")
    table = jaccard._bits(spark.createDataFrame([(6,), (8,)], "h long"), 1 << 16)
    got = sorted(map(tuple, jaccard._postings(rest, 70, table).collect()))
    assert got == [(1, 10, 1, 6), (1, 10, 3, 8), (2, 4, 0, 6)]
    assert [tuple(r) for r in jaccard._postings(rest, 90, table).collect() if r.node == 1] == [(1, 10, 1, 6)]


def test_tables_of_pivots_stay_small_on_the_driver(spark, documents, monkeypatch):
    sizes, parts, bits, store = [], [], jaccard._bits, jaccard.stored_copy

    def table(values, *n):
        sizes.extend(n)
        return bits(values, *n)

    def stored(df, purpose):
        parts.append(purpose)
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "_bits", table)
    monkeypatch.setattr(jaccard, "stored_copy", stored)
    monkeypatch.setattr(jaccard, "RATES", (2, 1))
    monkeypatch.setattr(jaccard, "SPARSE", 1 << 12)
    monkeypatch.setattr(jaccard, "WIDEST", 1 << 17)
    rows = near_copies(5, 40)
    got = {r.doc_id: tuple(r) for r in jaccard.jaccard_join(documents(rows)).collect()}
    assert got == brute_links(rows, 90, 3)
    assert parts.count("met") > 2 and max(sizes) <= 1 << 17  # before: one table, and so its fill, however many postings


def test_shared_bits_put_shared_shingles_last():
    data = np.frombuffer(b"a b c d e", np.uint8)
    (s,) = jaccard.shingle_sets(data, np.array([0, len(data)]))
    assert len(s) == 3 and jaccard._first(10, 90) == 2 and jaccard._first(1, 90) == 1


# -- lines ------------------------------------------------------------------------------


def brute_lines(rows, min_docs):
    docs = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").encode().split(b"\n"):
            if key := lines.line_key(x):
                docs[key].add(i)
    out = {}
    for i, t in rows:
        every = (t or "").encode().split(b"\n")
        kept = [x for x in every if len(docs.get(lines.line_key(x), ())) < min_docs]
        out[i] = (i, len(every), len(every) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest())
    return out


def test_lines_of_many_documents_go(spark, documents):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice([" Hot ", "HOT", "warm\t", "", f"own {i}", f"l{rng.randrange(40)}"]) for _ in range(rng.randrange(30)))) for i in range(120)]
    rows += [(500, None), (501, "hot\n" * 2000), (502, "\n")]
    got = {r.doc_id: tuple(r) for r in lines.line_digests(documents(rows), 10).collect()}
    assert got == brute_lines(rows, 10)


def test_a_line_that_spans_partitions(spark, documents):
    rows = [(i, "same\nown " + str(i % 7)) for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        got = {r.doc_id: tuple(r) for r in lines.line_digests(documents(rows), 10).collect()}
        first = {r.doc_id: r.text for r in lines.drop_lines(documents(rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_lines(rows, 10)
    assert first[0] == "same\nown 0" and first[3] == "own 3" and first[7] == "" and sum(t != "" for t in first.values()) == 7


def test_dropping_lines_keeps_the_other_columns(spark, documents):
    rows = [(i, "common line\nrest") for i in range(12)] + [(50, None), (50, None), (51, "common line")]
    df = documents([*rows, (None, "common line")])
    out = lines.drop_lines(df, 10)
    assert out.schema == df.schema and out.count() == df.count()
    texts = collections.Counter(r.text for r in out.collect())
    assert texts == {"": 13, None: 2, "common line": 1}  # "rest" is in twelve documents as well
    assert lines.drop_lines(documents([]), 10).count() == 0


def test_line_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op9_line_dedup"]).fetchall()
    assert sorted(map(tuple, queries.op9_line_dedup(spark, SMALL).collect())) == sorted(want)


# -- repeated strings -------------------------------------------------------------------


def brute_repeats(rows, length):
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for a in range(len(b) - length + 1):
            key = b[a : a + length]
            least[key] = min(i, least.get(key, i))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            if least[b[a : a + length]] < i:
                gone[a : a + length] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_against_brute_force(spark, documents, small):
    rng = random.Random(4)
    passage = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(40, 120))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([*passage, "zz", str(rng.random())]) for _ in range(rng.randrange(8)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "aaaa" * 100), (203, "aaaa" * 100), (204, "b" + "aaaa" * 30)]
    got = {r.doc_id: tuple(r) for r in suffix.span_digests(documents(rows), 50).collect()}
    assert got == brute_repeats(rows, 50)
    some = small[:60]
    got = {r.doc_id: tuple(r) for r in suffix.span_digests(documents(some), 50).collect()}
    assert got == brute_repeats(some, 50)


@pytest.mark.parametrize("length", [25, 87, 88, 100, 200, 1500])
def test_repeats_of_other_lengths(spark, documents, length):
    rng = random.Random(length)
    parts = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(length // 3, 4 * length))) for _ in range(6)]
    rows = [(i, "".join([rng.choice(parts), "".join(rng.choice("xyz") for _ in range(rng.randrange(30))), rng.choice(parts)])) for i in range(20)]
    rows += [(20, "w" * 3 * length), (21, "w" * 2 * length), (22, parts[0][: length - 1])]
    got = {r.doc_id: tuple(r) for r in suffix.span_digests(documents(rows), length).collect()}
    assert got == brute_repeats(rows, length)
    for wrong in (24, 1 << 19):
        with pytest.raises(ValueError):
            suffix.repeated_spans(documents(rows), wrong)


def test_strings_are_ranked_in_parts_of_the_size_of_the_texts(spark, documents, monkeypatch):
    stored, ranked, store = [], [], suffix.stored_copy

    def kept(df, purpose):
        stored.append(purpose)
        if purpose == "around":
            spots = df.selectExpr("explode(spots) as spot").selectExpr("sum(spot % (1 << 20) + 1)")
            ranked.append(spots.first()[0])
        return store(df, purpose)

    monkeypatch.setattr(suffix, "stored_copy", kept)
    monkeypatch.setattr(suffix, "bit_table", lambda values: np.full(suffix.BITS // 64, 2**64 - 1, np.uint64))  # full, as with many rows
    monkeypatch.setattr(suffix, "ROW", 1 << 8, raising=False)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = [" ".join(word() for _ in range(n)) for n in (4, 5, 7, 9, 20)]
    rows = [(i, " ".join(rng.choice(shared) if rng.random() < 0.1 else word() for _ in range(rng.randrange(1, 120)))) for i in range(60)]
    rows += [(60, "x" * 300), (61, rows[3][1]), (61, rows[3][1]), (62, None), (None, rows[4][1])]
    got = {r.doc_id: tuple(r) for r in suffix.span_digests(documents(rows), 50).collect()}
    want = brute_repeats({d: t for d, t in rows if d is not None}.items(), 50)
    assert {d: r for d, r in got.items() if d is not None} == want
    total = sum(len((t or "").encode()) for _, t in rows)
    assert stored.count("again") > 2  # before: the strings of all places went through one shuffle,
    assert 0 < ranked[0] < total / 2  # and with a full table those of nearly all places of the texts


def test_long_texts_are_read_in_pieces(spark, documents, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, text), (2, "x" + text[3000:6000] + "y"), (3, text)]
    want = brute_repeats(rows, 50)
    monkeypatch.setattr(suffix, "PIECE", 700)
    data = np.frombuffer(text.encode(), np.uint8)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    whole = sum(len(suffix.anchors(d, at, 50)[1]["lo"]) for _, _, d, at in suffix.pieces(iter([batch]), 50))
    assert whole >= len(suffix.anchors(data, np.array([0, len(data)]), 50)[1]["lo"])
    got = {r.doc_id: tuple(r) for r in suffix.span_digests(documents(rows), 50).collect()}
    assert got == want


def test_dropping_repeats(spark, documents):
    long = "the quick brown fox jumps over the lazy dog again and again until it is tired"
    df = documents([(1, long), (2, "new " + long), (3, None), (None, long), (1, long)])
    out = suffix.drop_repeats(df, 50)
    assert out.schema == df.schema
    assert sorted((r.doc_id or 0, r.text or "-") for r in out.collect()) == sorted([(1, long), (1, long), (2, "new "), (3, "-"), (0, long)])
    assert suffix.span_digests(documents([]), 50).count() == 0


def test_texts_of_one_id_have_their_own_spans(spark, documents):
    rng = random.Random(11)
    part, other, own = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (90, 130, 400))
    rows = [(1, part), (2, own + part), (2, "short"), (2, "y" + part + own), (3, other), (2, other[:60]), (4, other)]
    df = documents(rows)
    out = sorted((r.doc_id, r.text) for r in suffix.drop_repeats(df, 50).collect())
    # own is in two texts of one id, which is one document; other[:60] of 2 is repeated by 3 and 4
    assert out == sorted([(1, part), (2, own), (2, "short"), (2, "y" + own), (3, other[60:]), (2, other[:60]), (4, "")])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix.span_digests(df, 50).collect())
    assert got == sorted([(1, 90, 0, 0), (2, 490, 90, 1), (2, 5, 0, 0), (2, 491, 90, 1), (3, 130, 60, 1), (2, 60, 0, 0), (4, 130, 130, 1)])


# -- benchmark decontamination ----------------------------------------------------------


def brute_contamination(rows, items, width):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t or ""))

    wins = collections.defaultdict(set)
    for item, t in items:
        w = words(t)
        if w:
            k = min(len(w), width)
            for a in range(len(w) - k + 1):
                wins[tuple(w[a : a + k])].add(item)
    sizes = sorted({len(k) for k in wins})
    out = {}
    for i, t in rows:
        w = words(t)
        hit, found = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if (key := tuple(w[a : a + k])) in wins:
                    hit.update(range(a, a + k))
                    found |= wins[key]
        names = ",".join(sorted(map(str, found)))
        out[i] = (i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_contamination_against_brute_force(spark, documents, small):
    bench = duckdb.sql(f"select item_id, text from '{SMALL}/benchmark.parquet'").fetchall()
    bench += [(900, "short item"), (901, None), (902, "..."), (903, "The"), (904, bench[0][1])]
    rows = small + [(9000, f"x {bench[1][1].upper()} y"), (9001, "a SHORT, item! short item"), (9002, None), (9003, "")]
    got = {r.doc_id: tuple(r) for r in decontam.contamination(documents(rows), items_table(spark, bench)).drop("version").collect()}
    want = brute_contamination(rows, bench, 10)
    assert got == want and sum(w[5] for w in want.values()) > 3


def test_contamination_of_repeated_words(spark, documents):
    items = [(1, "a a a a a a a a a a a a"), (2, "b a " * 6), (3, "É é " * 5)]
    rows = [(1, "a " * 30), (2, "a b " * 9), (3, "é É é É é É é É é É"), (4, "É é " * 5), (5, "a " * 9)]
    got = {r.doc_id: tuple(r) for r in decontam.contamination(documents(rows), items_table(spark, items)).drop("version").collect()}
    assert got == brute_contamination(rows, items, 10)


def test_empty_tables_and_clean_rows(spark, documents):
    none = items_table(spark, [])
    df = documents([(1, "some words here"), (None, "some words"), (2, None)])
    assert decontam.contamination(df, none).where("contaminated").count() == 0
    assert decontam.contamination(documents([]), items_table(spark, [(1, "x y")])).count() == 0
    kept = decontam.keep_clean(df, items_table(spark, [(1, "words here")]))
    assert kept.schema == df.schema and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2]


def test_rows_without_an_id_are_looked_at(spark, documents):
    items = [(1, "one two three four"), (2, "five six"), (3, "seven")]
    rows = [(None, "x one two three four y"), (0, "x one two three y"), (None, "five six seven"), (None, "six five"), (5, "x one two three four y"), (None, None)]
    df, bench = documents([*rows, rows[0]]), items_table(spark, items)
    out = decontam.contamination(df, bench)
    assert out.schema["doc_id"] == df.schema["doc_id"]
    got = sorted((r.doc_id or -1 * (r.doc_id is None), r.n_words, r.n_hit, r.n_items, r.contaminated) for r in out.collect())
    assert got == [(-1, 0, 0, 0, False), (-1, 2, 0, 0, False), (-1, 3, 3, 2, True), (-1, 6, 4, 1, True), (-1, 6, 4, 1, True), (0, 5, 0, 0, False), (5, 6, 4, 1, True)]
    assert sorted((r.doc_id is None, r.text or "") for r in decontam.keep_clean(df, bench).collect()) == [(False, "x one two three y"), (True, ""), (True, "six five")]
    near = decontam.proximity_matches(df, items_table(spark, [(2, "five six")]), 3).collect()
    assert sorted((r.doc_id, r.first, r.last) for r in near) == [(None, 0, 1)] * 2


def test_proximity(spark, documents):
    df = documents([(1, "alpha x x beta"), (2, "alpha x x x x x beta"), (3, "beta alpha"), (4, "alpha")])
    got = decontam.proximity_matches(df, items_table(spark, [(7, "alpha beta")]), 5).collect()
    assert sorted((r.doc_id, r.item_id, r.first, r.last) for r in got) == [(1, 7, 0, 3), (3, 7, 0, 1)]


def brute_proximity(rows, items, span):
    out = set()
    for i, t in rows:
        w = (t or "").split()
        for item, text in items:
            terms = set(text.split())
            spans = [(a, b) for a in range(len(w)) for b in range(a, min(len(w), a + span)) if terms <= set(w[a : b + 1])]
            out |= {(i, item, a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)}
    return sorted(out)


def test_proximity_of_more_terms_against_brute_force(spark, documents):
    rng = random.Random(9)
    items = [(1, "alpha beta gamma"), (2, "alpha beta gamma delta"), (3, "gamma delta alpha gamma"), (4, "beta"), (5, "alpha none beta")]
    rows = [(1, "beta x x alpha x x x beta gamma"), (2, None)]
    rows += [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x", "y", "z"]) for _ in range(rng.randrange(60)))) for i in range(10, 60)]
    for span in (4, 6):
        got = decontam.proximity_matches(documents([*rows, rows[5]]), items_table(spark, items), span).collect()
        assert sorted((r.doc_id, r.item_id, r.first, r.last) for r in got) == brute_proximity(rows, items, span)
    assert (1, 1, 3, 8) in brute_proximity(rows, items, 6)
