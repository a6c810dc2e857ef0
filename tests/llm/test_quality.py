import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandbook.llm import quality as Q
from brandbook.llm.arrow import one_text_each


def corpus(n=900):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) + ("%%|"[i % 3] if bad and rng.random() < 0.5 else "") for _ in range(rng.randrange(20, 120))]
        docs.append((i, " ".join(words) + ".", f"s{i % 7}", "en", 1.0))
        if i % 3:
            labels.append((i, int(not bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    odd = [(None, None, None, None, 1.0), (5000, "", None, "en", 1.0), (1, docs[1][1], "s1", "en", 1.0), (5001, "w " * 50_000, "s1", None, 1.0)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in [*docs, *odd]], "doc_id long, text string, source string, lang string, posterior double, n int, s int, _scan int")
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, quality int")
    slim = Q.judge(frame, known, keep=["doc_id"]).collect()
    full = Q.judge(frame, known).collect()
    assert len(slim) == len(full) == len(docs) + len(odd)
    assert sorted(str((r.doc_id, r.posterior)) for r in slim) == sorted(str((r.doc_id, r.posterior)) for r in full)
    out = [r.kept == (r.doc_id % 5 != 0) for r in slim if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 0]
    assert sum(out) / len(out) > 0.95


def test_shrinkage(spark):
    rows = [("big", "a", 0.9)] * 500 + [("big", "b", 0.1)] * 3 + [("bad", "a", 0.1)] * 400 + [("one", "a", 0.1)] + [(None, None, 0.8)] * 2
    scored = spark.createDataFrame(rows, "h string, p string, p_doc double")
    table, prior = Q.sites(scored, "h", "p")
    got = {(r.h, r.p): r for r in Q.posterior(scored, table, prior, "h", "p").collect()}
    n, s = len(rows), sum(r[2] for r in rows)
    assert prior["mean"] == pytest.approx(s / n)
    host_n, host_s = 503, 450.3
    for (h, p), n_, s_ in ((("big", "a"), 500, 450.0), (("big", "b"), 3, 0.3)):
        own = 0.9 if p == "a" else 0.1
        above = (host_s - own + prior["host"] * prior["mean"]) / (host_n - 1 + prior["host"])
        assert got[h, p].p_host == pytest.approx(above, abs=1e-5)
        assert got[h, p].p_path == pytest.approx((s_ - own + prior["path"] * above) / (n_ - 1 + prior["path"]), abs=1e-5)
    # a site of one document says nothing but the prior about that document
    assert got["one", "a"].p_path == pytest.approx(prior["mean"], abs=1e-5)
    assert got["bad", "a"].p_path < 0.2 < 0.8 < got["big", "a"].p_path


@pytest.mark.parametrize(("labels", "p"), [([], 0.999), ([(1, 0)], 0.001), ([(1, 1), (9, 0)], 0.5)])
def test_without_two_kinds(spark, labels, p):
    docs = spark.createDataFrame([(1, "a b", "s", "l"), (2, None, None, "l")], "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    assert {r.p_doc for r in Q.judge(docs, known).collect()} == {p}
    assert Q.judge(docs.limit(0), known).count() == 0


def test_sites_earn_their_place(spark):
    """Weak evidence and hosts that differ: with sites the log loss of what the documents are is less, for hosts of many
    documents much less, for hosts of two no worse."""
    rng = random.Random(3)
    rows = []
    for h in range(120):
        rate = rng.choice([0.95, 0.25])
        for _ in range(2 if h % 2 else 60):
            good = rng.random() < rate
            odds = math.log(0.6 / 0.4) + rng.gauss(0.7 if good else -0.7, 1)
            rows.append((f"h{h}", f"p{h % 3}", round(1 / (1 + math.exp(-odds)), 6), good, h % 2 == 1))
    scored = spark.createDataFrame(rows, "h string, p string, p_doc double, good boolean, sparse boolean")
    table, prior = Q.sites(scored, "h", "p")
    got = Q.posterior(scored, table, prior, "h", "p").collect()

    def loss(sparse, field):
        own = [r for r in got if r.sparse == sparse]
        return -sum(math.log(max(1e-9, r[field] if r.good else 1 - r[field])) for r in own) / len(own)

    assert loss(False, "posterior") < 0.93 * loss(False, "p_doc") and loss(True, "posterior") < 1.01 * loss(True, "p_doc")


def test_a_hot_id_is_one_example(spark):
    """Of twenty labelled ids, one of them on 5,001 rows, the fit sees twenty rows at most, in a task."""
    rows = [(i, f"text of {i}. " * (i + 1)) for i in range(20)] + [(0, f"again {k}") for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(0, 1), (1, 1)], "doc_id long, quality int")
    chosen = labels.groupBy(labels.doc_id.alias("id")).agg(F.min("quality").alias("good"))
    texts = docs.selectExpr("doc_id AS id", "cast(text AS binary) AS text")
    assert one_text_each(texts, chosen, "id", "good").count() == 20
    model = Q.train(docs, labels, sample=8)
    few = chosen.selectExpr("id", "good", "xxhash64(id) AS h").orderBy("h", "id").limit(8)
    least = docs.groupBy("doc_id").agg(F.expr("min_by(text, struct(xxhash64(cast(text AS binary)), text))").alias("text"))
    picked = sorted((r.h, r.good, r.text) for r in few.join(least, few.id == least.doc_id).collect())
    want = Q.fit(np.round(np.array([Q.statistics(t) for _, _, t in picked]), 9), np.array([float(g) for _, g, _ in picked]))
    assert np.allclose(model["weights"], want["weights"]) and np.allclose(model["cuts"], want["cuts"]) and np.isclose(model["base"], want["base"])


def slow_judge(p, where, mean, host_strength, path_strength):
    """The posteriors by the formulas, one document after another over plain lists."""
    odds = lambda x: math.log(x / (1 - x))
    inside = lambda x: round(min(1 - Q.LEAST_P, max(Q.LEAST_P, x)), 6)
    for i, (host, path) in enumerate(where):
        others_h = [p[k] for k in range(len(p)) if k != i and where[k][0] == host]
        others_p = [p[k] for k in range(len(p)) if k != i and where[k] == (host, path)]
        p_host = inside((sum(others_h) + host_strength * mean) / (len(others_h) + host_strength))
        p_path = inside((sum(others_p) + path_strength * p_host) / (len(others_p) + path_strength))
        yield p_host, p_path, round(1 / (1 + math.exp(-(odds(p[i]) + odds(p_path) - odds(mean)))), 6)


def test_posteriors_against_brute_force(spark):
    rng = random.Random(9)
    where = [(rng.choice(["a", "b", None, "c"]), rng.choice(["x", None, "y"])) for _ in range(120)]
    p = [round(min(0.99, max(0.01, rng.gauss({"a": 0.8, "b": 0.3}.get(h, 0.5), 0.2))), 6) for h, _ in where]
    scored = spark.createDataFrame([(i, h, q, x) for i, ((h, q), x) in enumerate(zip(where, p))], "i int, host string, path string, p_doc double").repartition(3)
    table, prior = Q.sites(scored, "host", "path")
    assert abs(prior["mean"] - sum(p) / len(p)) < 1e-9
    got = sorted((r.i, r.p_host, r.p_path, r.posterior) for r in Q.posterior(scored, table, prior, "host", "path").collect())
    want = list(slow_judge(p, where, prior["mean"], prior["host"], prior["path"]))
    assert all(abs(a - b) < 2e-6 for (_, *g), w in zip(got, want, strict=True) for a, b in zip(g, w))
