"""Learned operators: held-out accuracy, the parts they are made of, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from homegrid.llm import langid, queries, quality, toxic
from homegrid.llm.labels import remainder, training_sample

MIDDLE = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, "12 345 !!"), (4, "x" * 3000), (5, "word " * 2000), (None, "text of none"), (6, "same"), (6, "same")]


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def held_out(rows, labels, column):
    got = rows.where("held_out").join(labels.select("doc_id", column), "doc_id").toPandas()
    return got.score.to_numpy(), got[column].to_numpy(), got.predicted.to_numpy()


def test_folds(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("r", remainder(5)).collect()
    assert all(r.r == zlib.crc32(str(r.doc_id).encode()) % 5 for r in ids)


def test_training_sample_leaves_out_the_held_out_fold(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 7) for i in range(60)] + [(None, 1, 7), (61, None, 7), (3, 0, 7)], "doc_id long, quality int, text int")
    docs = documents([(i, f"t{i}") for i in range(70)] + [(None, "x"), (2, None)])
    sample, share = training_sample(docs, labels, "quality", 10)
    rows = sample.collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows) and 0.3 < share < 0.7
    assert len({r.doc_id for r in rows if r.label == 0}) <= 10 and len(rows) <= 20
    assert all(r.label == 1 for r in rows if r.doc_id == 3)


# -- quality ----------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = queries.op3_quality(spark, MIDDLE)
    assert rows.count() == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    score, label, predicted = held_out(rows, labels, "quality")
    assert auc(score, label) > 0.95 and (predicted == label).mean() > 0.9
    assert ((score >= 0) & (score <= 1)).all() and ((score >= 0.3) == predicted).all()


def test_quality_gradients():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(11, quality.WIDTH)), np.array([0, 3, 3, 7, 11]), np.array([1.0, 0, 1, 0])
    model = quality.Model.new(x, y)
    model.w["a"] = rng.normal(size=quality.GATE)

    def loss():
        p = model.scores(x, bag)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, grad in model.gradients(x, bag, y).items():
        at = tuple(0 for _ in grad.shape)
        keep = model.w[name][at]
        model.w[name][at] = keep + 1e-6
        up = loss()
        model.w[name][at] = keep - 1e-6
        down = loss()
        model.w[name][at] = keep
        assert grad[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7)


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1200, quality.WIDTH))
    bag = np.arange(0, 1201, 4)
    y = (rng.random(300) < 0.5).astype(float)
    spot = bag[:-1] + rng.integers(0, 4, 300)
    x[spot[y == 0], 0] += 6
    model = quality.Model.new(x, y).fit(x, bag, y)
    weight = model.forward(x, bag)["weight"]
    assert auc(model.scores(x, bag), y) > 0.98
    assert weight[spot[y == 0]].mean() > 0.3


def test_quality_of_odd_rows(spark, documents):
    df = documents(ODD)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_quality(df, labels) is None
    rows = quality.score_quality(df, None).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.5}
    train = documents([(i, ("good words here. " if i % 2 else "BAD!! BAD!! $$$ ") * (i % 9 + 1)) for i in range(200)])
    model = quality.fit_quality(train, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int"))
    got = quality.score_quality(df, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    kept = quality.keep_good(train, model)
    assert kept.schema == train.schema and {r.doc_id % 2 for r in kept.collect()} == {1}
    assert quality.score_quality(documents([]), model).count() == 0


# -- language ---------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = queries.op4_language(spark, MIDDLE)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_filters_return_all_languages_of_a_gram():
    grams = np.arange(1, 2001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    names = [f"l{k:02d}" for k in range(70)]  # more than one word of masks
    owner = np.arange(2000) % 70
    f = langid.Filters.build(names, np.concatenate([grams, grams[:70]]), np.concatenate([owner, np.full(70, 69)]))
    share = f.shares(grams, np.arange(2000), 2000)
    assert (share[np.arange(2000), owner] > 0.99).all() and (share[:70, 69] > 0.99).all()
    assert (share > 0.5).sum() <= 2069 + 40


def test_language_of_odd_rows(spark, documents):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "and", "house"] if i % 2 else ["der", "und", "haus"]) for _ in range(9))) for i in range(80)]
    train = documents(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    f = langid.fit_languages(train)
    assert f.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.predict_languages(documents([*ODD[:3], (70, "the house"), (71, "das haus und"), (None, "the")]), f).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 70, 71, None)] == ["und", "und", "und", "en", "de", "en"]
    assert langid.fit_languages(documents([])) is None
    assert {r.lang_pred for r in langid.predict_languages(documents(ODD), None).collect()} == {"und"}


# -- toxicity ---------------------------------------------------------------------------


def brute_kernel(s, t):
    """Sum over all pairs of equal subsequences of ORDER letters of DECAY to the lengths that they span."""
    from itertools import combinations

    total = 0.0
    for a in combinations(range(len(s)), toxic.ORDER):
        for b in combinations(range(len(t)), toxic.ORDER):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += toxic.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_and_common_subsequences():
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(30)]
    other = words[::-1]
    got = toxic.kernel(toxic.codes(words), toxic.codes(other))
    assert got == pytest.approx([brute_kernel(s, t) for s, t in zip(words, other, strict=True)])

    def longest(s, t):
        row = [0] * (len(t) + 1)
        for x in s:
            row = [0] + [0] * len(t) if False else _step(row, x, t)
        return row[-1]

    def _step(row, x, t):
        new = [0]
        for j, y in enumerate(t):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        return new

    for w in words[:8]:
        assert toxic.common(toxic.codes(other), w).tolist() == [longest(o, w) for o in other]


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = queries.op10_toxicity(spark, MIDDLE)
    assert rows.count() == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    score, label, predicted = held_out(rows, labels, "toxic")
    assert auc(score, label) > 0.9 and (predicted == label).mean() > 0.93


def test_disguised_insults_and_odd_rows(spark, documents):
    rng = random.Random(8)
    plain = ["garden", "window", "table", "river", "stone", "letter", "number", "simple", "market", "summer"]
    rows = []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(20)]
        if i % 3 == 0:
            words[rng.randrange(20)] = rng.choice(["blockhead", "nitwit"])
        rows.append((" ".join(words) + ".", int(i % 3 == 0)))
    machine = toxic.fit_machine(rows)
    bad = ["a blockhead here", "you n i t w i t !", "block-head", "nitxwit", "BLOCKHEAD", "x" * 100 + "blockhead" + "y" * 100]
    assert (machine.scores(bad) > 0.5).all()
    assert (machine.scores(["", "garden table", "a stone river", "market"]) < 0.5).all()
    got = toxic.score_toxicity(documents(ODD), machine).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxic.fit_machine([]) is None and toxic.fit_machine([("a b c", 1)]) is None
    assert {r.score for r in toxic.score_toxicity(documents(ODD), None).collect()} == {0.0}
    assert toxic.score_toxicity(documents([]), machine).count() == 0
