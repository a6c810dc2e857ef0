import math
import random
from zlib import crc32

import numpy as np
import pytest

from brandbook.llm import toxicity as T


def corpus(n=900):
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 8 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        if toxic:
            for _ in range(2 + len(words) // 40):
                words.insert(rng.randrange(len(words)), rng.choice(["zorp", "quxli"]) + rng.choice(["", "a", "en", "ish"]))
        docs.append((i, " ".join(words), "x", 0.5))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    odd = [(None, "plain words", "x", 0.5), (8, docs[8][1], "x", 0.5), (10_001, "", "x", 0.5), (10_002, None, "x", 0.5), (10_003, "zorpen " + "abc " * 60_000, "x", 0.5)]
    frame = spark.createDataFrame([(*r, 1) for r in [*docs, *odd]], "doc_id long, text string, lang string, score double, _scan int")
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    model = T.train(frame, known)
    rows = T.score(frame, model).collect()
    assert len(rows) == len(docs) + len(odd)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    out = [(r.predicted, int(r.doc_id % 8 == 0)) for r in rows if r.held_out and r.doc_id < 900]
    assert sum(a == b for a, b in out) / len(out) > 0.97
    assert T.train(frame, known) == model


def test_held_out_labels_are_not_learned(spark):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    secret = lambda i: crc32(str(i).encode()) % 4 == 2
    flipped = [(i, q, 1 - t if secret(i) else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    assert T.train(frame, spark.createDataFrame(labels, schema)) == T.train(frame, spark.createDataFrame(flipped, schema))


def test_risk_is_not_negative():
    rng = np.random.default_rng(1)
    positive = T.Rows(np.ones(50, int), np.zeros(50, int), np.full(50, 9), np.full(50, 9), 2)
    unlabelled = T.Rows(np.ones(500, int), np.array([int(rng.random() > 0.3) for _ in range(500)]), np.full(500, 9), np.full(500, 9), 2)
    base, w = T.fit(positive, unlabelled, 0.3)
    assert T.sigmoid(base + positive.dot(w)[0]) > 0.8 and T.sigmoid(base + unlabelled.dot(w)).min() < 0.1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)]])
def test_without_two_kinds(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert [r.score for r in T.score(docs, model).collect()] == [float(labels == [(1, 1, 1)])] * 2
    assert T.score(docs.limit(0), model).count() == 0


def test_learns_from_as_many_examples_as_stated(spark):
    docs = spark.range(17_000).selectExpr("id as doc_id", "'some words' as text")
    labels = docs.selectExpr("doc_id", "int(doc_id < 6000) as toxic")
    n = {r.positive: r["count"] for r in T.sample(docs, labels, "text", "doc_id", T.POSITIVES, T.UNLABELLED).groupBy("positive").count().collect()}
    assert n == {True: 4_000, False: 12_000} and T.FEATURES == 8_192


def test_a_hot_id_is_one_example(spark):
    """Twenty labelled ids, one of them on 5,001 rows: the samples hold an id once, with its text of least hash."""
    ids = [i for i in range(200) if crc32(str(i).encode()) % 4 != 2][:20]
    rows = [(i, f"text of {i}") for i in ids] + [(ids[0], f"again {k}") for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, int(i in ids[:4])) for i in ids] + [(ids[0], 1)] * 3, "doc_id long, toxic int")
    got = T.sample(docs, labels, "text", "doc_id", 4, 8).collect()
    assert len(got) == 4 + 8 and sum(r.positive for r in got) == 4
    first = docs.where(f"doc_id = {ids[0]}").selectExpr("text", "xxhash64(cast(text as binary)) h").orderBy("h").first().text
    assert {bytes(r.text).decode() for r in got if r.positive} == {first, *(f"text of {i}" for i in ids[1:4])}


def slow_fit(p, u, prior, steps, rate, decay):
    """The same descent over plain lists, the gradient of the risk by differences."""
    def g(theta, row):
        (pairs, words) = row
        out = theta[0] + theta[-1] * math.log1p(words)
        width = (len(theta) - 2) // 2
        for slot, hits in pairs:
            out += theta[1 + slot] * T.PRESENCE * math.log1p(hits) + theta[1 + width + slot] * hits / math.sqrt(words + 20)
        return out

    soft = lambda x: math.log1p(math.exp(-abs(x))) + max(x, 0)
    mean = lambda rows, f: sum(map(f, rows)) / len(rows)
    width = 1 + max(s for r in (*p, *u) for s, _ in r[0])
    theta = [math.log(prior / (1 - prior))] + [0.0] * (2 * width + 1)
    m, v = [0.0] * len(theta), [0.0] * len(theta)
    for step in range(1, steps + 1):
        negative = lambda th: mean(u, lambda r: soft(g(th, r))) - prior * mean(p, lambda r: soft(g(th, r)))
        whole = lambda th: prior * mean(p, lambda r: soft(-g(th, r))) + negative(th)
        risk = whole if negative(theta) >= 0 else lambda th: -negative(th)
        for i in range(len(theta)):
            up, down = list(theta), list(theta)
            up[i] += 1e-6
            down[i] -= 1e-6
            slope = (risk(up) - risk(down)) / 2e-6 + (decay / len(p) * theta[i] if i else 0)
            m[i], v[i] = 0.9 * m[i] + 0.1 * slope, 0.999 * v[i] + 0.001 * slope**2
        theta = [x - rate * (a / (1 - 0.9**step)) / (math.sqrt(b / (1 - 0.999**step)) + 1e-8) for x, a, b in zip(theta, m, v)]
    return theta


def test_fit_against_a_slow_reference():
    rng = random.Random(2)
    row = lambda slots: (sorted((s, rng.randrange(1, 5)) for s in slots), rng.randrange(5, 60))
    p = [row({0, *rng.sample(range(1, 5), 2)}) for _ in range(12)]
    u = [row(set(rng.sample(range(1, 5), 2)) | ({0} if i % 6 == 0 else set())) for i in range(30)]
    flat = lambda x, i: np.array([pair[i] for r, _ in x for pair in r])
    rows = lambda x: T.Rows(np.array([len(r) for r, _ in x]), flat(x, 0), flat(x, 1), np.array([w for _, w in x]), 5)
    for prior in (0.2, 0.9):  # with the second the negative risk turns below zero
        intercept, weights = T.fit(rows(p), rows(u), prior, steps=25, rate=0.06, decay=0.01)
        assert [intercept, *weights] == pytest.approx(slow_fit(p, u, prior, 25, 0.06, 0.01), abs=2e-3)
