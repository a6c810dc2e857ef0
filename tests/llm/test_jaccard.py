import random

import pytest

import corpus_pipeline as P
from brandbook.llm import simhash as S


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(2000)}"
    notice = [word() for _ in range(12)]
    texts = []
    for i in range(12):
        base = [word() for _ in range(rng.randrange(40, 200))] + notice
        for _ in range(60 if i == 0 else 6):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return [*texts, texts[3], texts[3].upper(), None, "", "one two", "One  two", "one three"]


@pytest.mark.parametrize(("direct", "known"), [(64, 2), (3, 2), (3, 10**9), (1, 10**9)])
def test_groups_are_exact(spark, monkeypatch, direct, known):
    monkeypatch.setattr(S, "COMMON", known)
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = brute(texts)
    first = {}
    for i, g in enumerate(group):
        first[g] = min(i, first.get(g, i))
    got = {r.doc_id: r.component_id for r in S.similar(docs, direct=direct).collect()}
    assert got == {i: first[g] for i, g in enumerate(group)}
    assert S.similar(docs.limit(0)).count() == 0


def test_stage_finds_what_two_bits_miss(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = dict(P.STAGES)["near_duplicates"](spark, docs, "")
    assert kept.count() == len(set(brute(texts))) < S.keep_one(docs).count()
