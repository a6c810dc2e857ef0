import random
import re
from collections import Counter

from brandbook.llm import decision_list as L


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(triples)
    hit = {i + k for i, t in enumerate(triples) if counts[t] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(lines)


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", " a b ", "a b c a b c", "x y z x y z x", "a a a a", "a a a", "Ü # é|é\n\t\nÜ # é|é\n", "\u00a0 \u2028x", "a\x0bb\x0cc\r\nd\r\n", "w " * 30_000, "|" * 10]
    texts += [" ".join(rng.choice("ab cd\n ef <g>".split(" ")) for _ in range(rng.randrange(60))) for _ in range(60)]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    got = {r.doc_id: tuple(r)[1:] for r in L.statistics(frame).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t


def corpus():
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) + ("#$"[i % 2] if bad and rng.random() < 0.7 else "") for _ in range(80)]
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_learns_and_holds_out(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (None, "few words"), (1, rows[1][1])], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5, None), (None, 0)], "doc_id long, quality int")
    judged = L.judge(docs, known, sample=1000)
    assert "Python" not in judged._jdf.queryExecution().toString()
    got = [(r.doc_id, r.base_failed, r.kept) for r in judged.collect()]
    assert len(got) == 602
    for doc, failed, kept in got:
        assert (failed, kept) == ((True, False) if doc is None else (False, doc % 4 != 0))
    rules = L.learn(L.statistics(docs), known)
    assert [str(c) for c in rules[0]][0].startswith("symbols_per_word >")


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "word " * 3), (2, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in L.judge(docs, none).collect()} == {1: False, 2: True}
    assert L.judge(docs.limit(0), none).count() == 0
