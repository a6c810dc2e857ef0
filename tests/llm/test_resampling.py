import hashlib
import math
import random
import re
import zlib
from collections import Counter

from brandbook.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, orders=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for i in range(len(words)) for k in range(1, orders + 1) if i + k <= len(words)]


def brute(docs, target):
    buckets = lambda text: [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (t_s + 10_000) / ((s[b] + 1) * (t_t + 10_000)))) for t_s, t_t in [(s.total(), t.total())] for b in range(10_000)}
    rows = []
    for doc_id, text in docs:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets(text))
        rows.append((doc_id, len(features(text)[1]), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), features(text)[0]))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0], r[2], r[1]))
    ranks = [(*r[:4], k if k <= 5 * len(able) // 100 else None) for k, r in enumerate(able, 1)]
    return ranks + [(*r[:4], None) for r in rows if r[4] < 20]


def some_docs():
    rng = random.Random(6)
    words = ["Alpha", "beta", "ÉCOLE", "école", "x1", "日本", "GAMMA", "delta", "İ", "ß", "the", "of", "a-b", "'s", "{c}", "zé@q"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(15, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,! "), (303, "One"), (304, "one two"), (None, "of the alpha " * 9), (305, "Alpha beta " * 20_000), (306, "y" * 50_000)]
    return docs + [(7, "alpha beta delta " * 8)] * 3 + [(i, "the of the of " * 6) for i in range(400, 460)]


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_against_brute_force(spark):
    docs, target = some_docs(), ["Alpha beta gamma", None, "", "the of", "école ÉCOLE x1"]
    rows = spark.createDataFrame([(*d, 1, 2, "z") for d in docs], "doc_id long, text string, row int, b1 int, words string").repartition(5).sortWithinPartitions("doc_id", "text")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert plain(R.resample(rows, wanted).collect()) == plain(brute(docs, target))


def test_empty_tables(spark):
    docs = spark.createDataFrame(some_docs(), "doc_id long, text string")
    none = docs.limit(0)
    assert R.resample(none, docs).count() == 0
    assert plain(R.resample(docs.coalesce(1), none).collect()) == plain(brute(some_docs(), []))


def test_other_orders_and_draw(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b"), (3, "q"), (3, "r s t u v")], "doc_id long, text string")
    table = R.positions(docs, orders=2, buckets=50)
    assert table.columns == ["row", "id", "n_words", "b1", "b2"]
    assert sum(r.n for r in R.bucket_counts(table).collect()) == 7 + 3 + 1 + 9
    ranked = R.resample(docs, docs, orders=2, buckets=50, least_words=1, per_cent=50)
    chosen = {r.doc_id for r in ranked.where("rank is not null").collect()}
    assert sorted(r["rank"] for r in ranked.where("rank is not null").collect()) == [1, 2]
    assert {r.doc_id for r in R.drawn(docs, ranked).collect()} == chosen


def test_one_exchange_of_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    plan = R.positions(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan
