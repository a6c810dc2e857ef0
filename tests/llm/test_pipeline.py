import random

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_mixture import brute as copies
from tests.llm.test_simhash import brute_groups, brute_print


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    plain = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    words = lambda n: [rng.choice(plain) for _ in range(n)]
    items = [(i, " ".join(words(30))) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        w, toxic, poor = words(rng.randrange(60, 150)), i % 10 == 3, i % 10 == 7
        if toxic:
            w[::12] = ["zorp" + x for x in w[::12]]
        if poor:
            w = [x + "%%%" for x in w]
        if i % 10 == 5:
            w[10:10] = items[i % 5][1].split()
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 1, i))
        labels.append((i, int(not poor), int(toxic)))
    rows += [(1000 + i, rows[10 * i][1], "en", "s0", 1, 0) for i in range(20)] + [(2000, None, None, None, None, None), (None, rows[0][1], "en", "s0", 1, 0), (0, *rows[0][1:])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score long"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    d = str(tmp_path)
    stage = dict(P.STAGES)
    clean = stage["toxicity"](spark, docs, d)
    assert clean.columns == docs.columns
    left = [tuple(r) for r in clean.collect()]
    assert set(map(str, left)) <= set(map(str, rows))
    assert not any(r[0] is not None and r[0] < 400 and r[0] % 10 == 3 for r in left) and len(left) >= 375
    good = [tuple(r) for r in stage["quality"](spark, spark.createDataFrame(left, schema), d).collect()]
    assert not any(r[0] is not None and r[0] < 400 and r[0] % 10 == 7 for r in good) and len(good) >= 335

    one = [tuple(r) for r in stage["near_duplicates"](spark, spark.createDataFrame(good, schema), d).collect()]
    prints = {r[1]: brute_print(r[1]) for r in good}
    group = brute_groups(sorted(set(prints.values())))
    least = {}
    for r in good:
        g = group[prints[r[1]]]
        least[g] = min(least.get(g, 10**9), 10**9 if r[0] is None else r[0])
    assert sorted(r[0] for r in one) == sorted(least.values())
    free = [tuple(r) for r in stage["decontamination"](spark, spark.createDataFrame(one, schema), d).collect()]
    assert sorted(map(str, free)) == sorted(str(r) for r in one if not contaminated(r[1], items)[4])
    final = stage["mixture"](spark, spark.createDataFrame(free, schema), d).collect()
    n = {s: sum(r[3] == s for r in free) for s in {r[3] for r in free}}
    total = sum(x**0.5 for x in n.values())
    assert sorted(str(r.doc_id) for r in final) == sorted(str(r[0]) for r in free for _ in range(copies(r[0], n[r[3]] ** 0.5 / total * len(free) / n[r[3]])))
    assert sorted(str(tuple(r)) for r in P.run(spark, d).collect()) == sorted(str(tuple(r)) for r in final)


def test_stages_over_nothing(spark, tmp_path):
    """No labels, no benchmark items, and documents of nulls and empties, or none at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, predicted int"
    rows = [(None, None, None, None, None, None), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "w " * 40_000, None, "s", 1, 2), (3, "a b c d e f g", "en", None, 1, 3)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES:
        kept = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(kept.columns), name
        n = kept.count()
        assert n == {"near_duplicates": 3}.get(name, 5) or name == "mixture", name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
