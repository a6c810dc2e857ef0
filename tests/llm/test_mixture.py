import hashlib
import math
from collections import Counter

import duckdb
import pytest

from brandbook.llm import mixture as M


def brute(doc, rate):
    u = (int(hashlib.md5(f"{M.SEED}:{'' if doc is None else doc}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, p = 0, math.exp(-rate)
    f = p
    while f < u:
        k += 1
        p *= rate / k
        f += p
    return k


def test_counts_against_brute_force(spark):
    rows = [(i, f"t{i}", ("a", "a", "a", "b", None)[i % 5], i) for i in range(500)] + [(None, None, "c", 1), (7, "", "c", 2), (7, "", "c", 2)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, source string, copy int, times int, u int, row int")
    weights = {"a": 1.0, "b": 3.0, None: 2.0}
    n = Counter(r[2] for r in rows)
    rate = {s: weights.get(s, 0) / 6 * len(rows) / n[s] for s in n}
    got = Counter((r.doc_id, r.source) for r in M.mix(docs, weights).collect())
    want = Counter()
    for d, _, s, _ in rows:
        want[d, s] += brute(d, rate[s])
    assert got == +want
    share = Counter(s for (_, s), k in got.items() for _ in range(k))
    assert share["b"] / sum(share.values()) == pytest.approx(0.5, abs=0.08)
    assert M.mix(docs.limit(0)).count() == 0 and M.mix(docs, {"zzz": 1.0}).count() == 0
    with pytest.raises(ValueError, match="repeated"):
        M.mix(docs, {"c": 1.0}, total=1e6)


def test_large_rate(spark):
    got = spark.range(1).select(M.cumulative(M.F.lit(900.0)).alias("c")).first().c
    assert abs(got[-1] - 1) < 1e-9 and sum(x < 0.5 for x in got) in (899, 900)


def test_sql(spark, tmp_path):
    rows = [(i, f"t{i}", "en", f"s{int(i**0.5) % 7}", i) for i in range(800)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents = docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(map(str, con.sql(M.MIX_SQL).fetchall())) == sorted(str(tuple(r)) for r in M.mix(docs).collect())


def test_every_rate_has_a_result(spark):
    docs = spark.range(6002).selectExpr("id as doc_id", "'t' as text", "if(id < 6000, 'a', if(id = 6000, 'b', null)) as source")
    got = Counter(r.doc_id for r in M.mix(docs, temperature=0.0).collect() if r.doc_id >= 6000)
    rate = 6002 / 3
    for doc in (6000, 6001):
        u = (int(hashlib.md5(f"{M.SEED}:{doc}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k = f = 0
        while (f := f + math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))) < u:
            k += 1
        assert got[doc] == k
    listed = spark.range(1).select(M.cumulative(M.F.lit(50_000.0)).alias("c"), M.first_listed(M.F.lit(50_000.0)).alias("k")).first()
    assert abs(listed.c[-1] - 1) < 1e-9 and listed.k + sum(x < 0.5 for x in listed.c) in (49_999, 50_000)
