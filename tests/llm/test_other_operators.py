"""Chat formatting, nearest neighbours, components and the pipeline."""

import collections
import hashlib
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from homegrid.llm import ann, chat, queries
from homegrid.llm.components import components
from tests.conftest import SMALL

# -- chat -------------------------------------------------------------------------------


def test_escapes_read_back():
    rng = random.Random(1)
    signs = ["[INST]", "[/INST]", "</s>", "\\", "\\e", "[", "<", "\n", "é", "ok "]
    for _ in range(300):
        turns = [("".join(rng.choice(signs) for _ in range(rng.randrange(6))), "".join(rng.choice(signs) for _ in range(rng.randrange(9)))) for _ in range(3)]
        text = "".join(chat.render(r, t)[0] for r, t in turns)
        assert chat.read_back(text) == turns
    with pytest.raises(ValueError):
        chat.read_back("[INST]user[/INST]no end")


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 0, 1, "delta", "user", "Hel"), (1, 0, 2, "delta", None, "lo"), (1, 1, 3, "delta", "assistant", "bad"), (1, 1, 4, "regenerate", None, ""),
        (1, 1, 5, "delta", None, "go"), (1, 1, 6, "delta", None, "od"), (1, 0, 7, "edit", None, "Hi"), (2, 0, 1, None, None, None), (None, 0, 1, "delta", "user", "x"),
    ]
    rows = chat.format_conversations(spark.createDataFrame(log, chat.EVENTS).repartition(3)).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.conv_id] += chat.read_back(r.formatted)
        if r.loss_start is not None:
            assert r.formatted[r.loss_start : r.loss_end] == "good"
    assert got == {1: [("user", "Hi"), ("assistant", "good")], 2: [("", "")], None: [("user", "x")]}
    assert chat.format_conversations(spark.createDataFrame([], chat.EVENTS)).count() == 0


def test_chat_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op7_chat"]).fetchall())
    got = sorted(map(tuple, queries.op7_chat(spark, SMALL).collect()))
    assert got == want and got[0][0] == -7
    said = "</s>[INST] ok [/INST]"
    assert got[0][4] == hashlib.sha256(said.encode()).hexdigest() and got[0][3] == len(said)


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (2, None, None, "x" * 9000), (None, 0, "user", "a"), (3, 5, "user", "<\\["), (3, 4, "assistant", "é" * 4001)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, message int")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(chat.events_of(df))).collect()}
    assert {k: v.n_turns for k, v in got.items()} == {1: 3, 2: 1, None: 1, 3: 2}
    assert got[3].turns_sha256 == hashlib.sha256(("assistant\n" + "é" * 4001 + "\nuser\n<\\[\n").encode()).hexdigest()
    assert got[3].loss_chars == 4001 and got[2].loss_chars == 0
    assert chat.conversation_digests(chat.format_conversations(chat.events_of(df.limit(0)))).count() == 0


# -- nearest neighbours -----------------------------------------------------------------


def brute_nearest(ids, e, every, top):
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = np.einsum("d,rd->r", e[q], e)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:top]
        out[int(ids[q])] = [int(ids[i]) for i in order]
    return out


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    p = df.toPandas()
    want = brute_nearest(p.vec_id.to_numpy(), np.stack(p.embedding).astype(float), 20, 20)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) > 0.9


def test_recall_where_most_lists_are_not_visited(spark, monkeypatch):
    rng = np.random.default_rng(4)
    e = rng.normal(size=(12_000, 16))  # they point anywhere
    monkeypatch.setattr(ann, "LIST", 12)
    asked, fit = [], ann.fit_ratio

    def spied(graph, x, *rest):
        asked.append((graph, x, fit(graph, x, *rest)))
        return asked[-1][2]

    monkeypatch.setattr(ann, "fit_ratio", spied)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(e.tolist())], "vec_id long, embedding array<double>").repartition(8)
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    want = brute_nearest(np.arange(len(e)), e, 20, 20)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) > 0.95
    graph, x, ratio = asked[0]
    assert len(graph.centers) == 1000 and 48 < len(graph.visits(x, ratio)[0]) / len(x) < 500


def test_visits_are_all_within_the_ratio():
    rng = np.random.default_rng(6)
    graph, x = ann.Graph.build(rng.normal(size=(1500, 10))), rng.normal(size=(40, 10))
    d = graph.distances(x)
    for ratio in (1.5, 3.0, float("inf")):
        want = d <= ratio * d.min(1, keepdims=True)
        seen = np.zeros(d.shape, bool)
        seen[graph.visits(x, ratio)] = True
        assert (seen & want).sum() > 0.97 * want.sum() and (seen.all() or ratio < float("inf"))


def test_few_vectors_are_exact(spark):
    rng = np.random.default_rng(2)
    e = np.round(rng.normal(size=(60, 8)) * rng.integers(1, 5, (60, 1)), 2)
    e[20:45] = e[20]  # many equal vectors
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(e)]
    odd = [(100, None, 1), (120, [0.0] * 8, 1), (140, [float("nan")] * 8, 1), (160, [1.0] * 3, 1), (180, [None] * 8, 1), (200, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (7, rows[7][1], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert got == brute_nearest(np.arange(60), e, 20, 20)
    assert ann.nearest(df.limit(0)).count() == 0
    one = ann.nearest(df.where("vec_id = 20"))
    assert one.count() == 0


def test_candidates_follow_the_queries_not_the_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 16)
    e = np.random.default_rng(4).normal(size=(4000, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "vec_id long, embedding array<double>").repartition(4)
    visits, rows, fit, best_of = [], [], ann.fit_ratio, ann.best_of

    def fitted(graph, x, *known):
        ratio = fit(graph, x, *known)
        visits.append(len(graph.visits(x, ratio)[0]) / len(x))
        return ratio

    def counted(found, top):
        rows.append(found.count() / 200)
        return best_of(found, top)

    monkeypatch.setattr(ann, "fit_ratio", fitted)
    monkeypatch.setattr(ann, "best_of", counted)
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    want = brute_nearest(np.arange(4000), e, 20, 20)
    assert np.mean([len(set(want[q]) & set(got[q])) / 20 for q in want]) > 0.95
    assert visits[0] > 2 * ann.VISITED_LEAST
    assert rows[0] <= 20 * ann.VISITED_LEAST and rows[1] < 20 * 8  # before: up to 20 from each list


def test_graph_search_finds_the_nearest_centers():
    rng = np.random.default_rng(3)
    centers, x = rng.normal(size=(400, 10)), rng.normal(size=(50, 10))
    ids, dist = ann.Graph.build(centers).search(x, 64)
    d = ((x[:, None] - centers[None]) ** 2).sum(2)
    best = np.argsort(d, axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) for a, b in zip(ids, best, strict=True)]) > 9
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in ids)


# -- components -------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 120)] + [(7, 7), (1, 0), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, before, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns and after.count() <= before.count()
        before = after
    left = {r.doc_id: r for r in before.collect()}
    assert all(r.n_chars == len(r.text) for r in left.values())
    assert len(left) > 0.5 * docs.count()
    from tests.llm.test_text_operators import brute_contamination, brute_lines, brute_links

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "quality")).collect()]
    lined = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "lines")).collect()]
    want = brute_lines(rows, 10)
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in lined} == {i: w[3] for i, w in want.items()}
    groups = brute_links(lined, 80, 5)
    single = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "near_copies")).collect()]
    assert {i for i, _ in single} == {i for i, g in groups.items() if g[2] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert left.keys() == {i for i, w in brute_contamination(single, bench, 10).items() if not w[5]}
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} == left.keys() and all(r.n_tokens > 0 or not left[r.doc_id].text.strip() for r in out)
