import random

import pytest
from pyspark.sql import functions as F

from brandbook.operators import frontier as Q
from brandbook.operators import progress as P
from brandbook.schema import FRONTIER, STATUS


def test_queue_lives(spark):
    queue = spark.createDataFrame([("CHIA", "1", "done", 0, 0, 1, None, None, None)], FRONTIER)
    seeds = spark.createDataFrame([("chia", " 1", 5), ("chia", "2", 0), ("CHIA", "2", 3), ("MAINE", "9", 0)], "association string, reg_number string, priority int")
    q = Q.seeded(queue, seeds, 1, F.lit("now")).cache()
    got = {(r.association, r.reg_number): (r.status, r.depth, r.priority) for r in q.collect()}
    assert got == {("CHIA", "1"): ("done", 0, 5), ("CHIA", "2"): ("pending", 1, 3), ("MAINE", "9"): ("pending", 1, 0)}
    assert [r.reg_number for r in Q.pick(q, 2).collect()] == ["2", "9"]
    fail = spark.createDataFrame([("CHIA", "2", "failed", "x" * 600), ("MAINE", "9", "refused", None)], "association string, reg_number string, outcome string, error string")
    once = Q.visited(q, fail, F.lit("t"), 2)
    row = once.where("reg_number = '2'").first()
    assert (row.status, row.attempts, len(row.last_error)) == ("pending", 1, 500)
    twice = Q.visited(once, fail, F.lit("t"), 2)
    assert {r.reg_number: r.status for r in twice.collect()} == {"1": "done", "2": "failed", "9": "pending"}
    assert {r.reg_number: r.attempts for r in Q.reset(twice, "failed").collect()}["2"] == 0
    assert {r.status: r.n for r in Q.status_counts(Q.parked(twice, "chia", F.lit("t"))).collect()} == {"done": 1, "failed": 1, "skipped": 1}
    assert [tuple(r) for r in Q.pending_by_association(twice).collect()] == [("MAINE", 1)]


def test_breadth_first_and_backoff(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "x1"), ("c", "d")], "node string, next string")
    seeds = spark.createDataFrame([("a",), ("a",)], "node string")
    got = {r.node: r.depth for r in Q.breadth_first(links, seeds, 2, ~F.col("node").startswith("x")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    visits = spark.createDataFrame([("k", i, i not in (2,), 7 if i == 4 else None) for i in range(9)], "k string, i int, refused boolean, after int")
    rows = Q.refusal_streaks(visits, "k", ["i"], F.col("refused"), F.col("after")).orderBy("i").collect()
    assert [r.streak for r in rows] == [1, 2, 0, 1, 2, 3, 4, 5, 6] and [r.wait for r in rows][:6] == [30, 60, 0, 30, 7, 90]
    assert [r.stop for r in rows] == [False] * 7 + [True] * 2


def points(spark, ts):
    return spark.createDataFrame([("A", t, t, 1) for t in ts], "association string, t bigint, done bigint, pending bigint")


def test_sampling_and_thinning(spark):
    assert [r.t for r in P.sample(points(spark, [0, 30, 660, 660, 1100, 1261]), "association", "t").orderBy("t").collect()] == [0, 660, 1261]
    now = 1_700_000_000
    kept = [r.t for r in P.compact(points(spark, range(now - 864_000, now + 1, 600)), F.lit(now)).collect()]
    assert 300 < len(kept) < 1441 / 3 and max(kept) == now
    assert P.compact(points(spark, range(now - 5000 * 21_600, now, 21_600)), F.lit(now)).count() == 700


def test_series_and_rates(spark):
    rows = spark.createDataFrame([("CHIA", 1, 100, 70), ("MAINE", 1, 80, 50), ("CHIA", 2, 110, 60), ("X", 0, 0, 0)], "association string, t bigint, done bigint, pending bigint")
    assert [tuple(r) for r in P.carried_forward(rows).orderBy("t").collect()] == [(1, 180, 120), (2, 190, 110)]
    assert [r.rate_per_min for r in P.rates(rows).where("association = 'CHIA'").orderBy("t").collect()] == [None, 600.0]


def test_board(spark):
    when = "2024-01-01T00:00:00Z"
    now = F.lit(1_704_067_200 + 60).cast("long")
    rows = spark.createDataFrame([("CHIA", 10, 2880, 1, 1.0, when), ("MAINE", 5, 1, 0, 0.0, None)], "association string, done bigint, pending bigint, failed bigint, rate_per_min double, updated_at string")
    board = P.boards(rows, spark.createDataFrame([("CHIA", 101_940, 2800)], "association string, registrations bigint, behind bigint"), now)
    by = {r.association: r for r in board.collect()}
    assert (by["CHIA"].graphed, by["CHIA"].behind, by["CHIA"].stale, by["CHIA"].etaDays) == (101_940, 2800, False, 2.0)
    assert (by["MAINE"].graphed, by["MAINE"].stale, by["MAINE"].etaDays) == (None, True, None)
    t = P.totals(board).first()
    assert (t.done, t.pending, t.failed, t.behind, t.etaDaysOverall) == (15, 2881, 1, 2800, 2.0)
    assert P.boards(rows, None, now).where("graphed is null").count() == 2 and P.rollup(board).count() == 3
    picked = P.newest(spark.createDataFrame([("A", None, 1), ("A", when, 2), ("A", when, 3)], "k string, at string, o int"), "k", "at", "o").first()
    assert picked.o == 2
    label = spark.createDataFrame([(True, False, "x", 99), (False, True, "running", 1), (False, False, "stopped", 1), (False, False, "running", 5), (False, False, "running", 50)], "a boolean, s boolean, st string, age int")
    assert [r.l for r in label.select(P.state_label(F.col("a"), F.col("s"), F.col("st"), F.col("age")).alias("l")).collect()] == ["running", "stopped", "stopped", "running", "idle"]
    assert [r.l for r in spark.createDataFrame([(True, when), (True, "2023-12-31T23:00:00Z"), (False, when), (True, None)], "ok boolean, at string").select(P.loading(F.col("ok"), F.col("at"), now).alias("l")).collect()] == [True, False, False, False]


def test_load_lag_and_health(spark):
    lag = P.file_lag(spark.createDataFrame([("A", 50, 5), ("B", 0, 0)], "association string, offset bigint, loaded bigint"), spark.createDataFrame([("A", 150), ("B", 10), ("C", 0)], "association string, size bigint"))
    assert {r.association: (r.behind_bytes, r.behind) for r in lag.collect()} == {"A": (100, 10), "B": (10, None), "C": (0, 0)}
    load = P.load_progress(spark.createDataFrame([("A", 30)], "association string, n bigint"), spark.createDataFrame([("A", 20), ("B", 4)], "association string, n bigint"))
    assert {r.association: (r.written, r.remaining, r.pct) for r in load.collect()} == {"A": (20, 0, 100.0), "B": (0, 4, 0.0)}
    crawl = spark.createDataFrame([("A", None, 10, "active"), ("B", None, 900, "active"), ("C", "bad", None, None), ("D", None, 1, "failed")], "association string, error string, age bigint, unit string")
    found = P.problems(crawl, spark.createDataFrame([("A", 9000)], "association string, behind bigint"), 700)
    assert {(r.association, r.problem) for r in found.collect()} == {("B", "crawler silent"), ("C", "unreadable status file"), ("D", "unit is failed"), ("A", "not yet in the graph"), (None, "loader has not advanced")}


def test_published_and_validated(spark):
    rows = spark.createDataFrame([("A", "running", ("A", "1", "N", "Red", "d", "M", []), {"done": 0}, 1, 1.0, 1.0, 9, "t"), ("B", "idle", None, {"done": 0}, 0, 0.0, 0.0, 9, "t")], STATUS)
    got = P.published(rows).collect()
    assert len(got) == 1 and set(got[0].current.asDict()) == {"association", "reg", "name"} and "pid" not in got[0].asDict()
    load = spark.createDataFrame([({"association": "CHIA", "done": "5"},), ({"association": "chia"},), ({"association": "CHIA", "x": "1"},), ({"association": "CHIA", "done": "many"},)], "p map<string,string>")
    assert [r.e for r in load.select(P.payload_error(F.col("p"), ["association", "done"], ["done"], "association").alias("e")).collect()] == [None, "bad code", "unexpected field: x", "not a number: done"]
    assert not P.may_replace(rows, rows.limit(0)) and P.may_replace(rows, rows.limit(0), True) and P.may_replace(rows.limit(0), rows.limit(0))


def test_rules_and_boards(spark):
    queue = spark.createDataFrame([("A", "/ok/1"), ("A", "/no/1"), ("A", "/no/but/1")], "association string, path string")
    rules = spark.createDataFrame([("/no/", False), ("/no/but", True)], "prefix string, allow boolean")
    assert {r.path for r in Q.allowed(queue, rules, F.col("path")).collect()} == {"/ok/1", "/no/but/1"}
    kind = "source string, publishedAt string, boards array<struct<association:string,done:int,updated_at:string>>, graph string"
    entries = spark.createDataFrame([("x", "2", [("A", 1, "t1"), ("B", 5, None)], None), ("y", "1", [("A", 2, "t2"), ("B", 6, None)], "g")], kind)
    assert {r.association: (r.done, r.source) for r in P.merged_boards(entries).collect()} == {"A": (2, "y"), "B": (5, "x")}
    assert P.newest_graph(entries).first().graph == "g"
    assert [r.t for r in P.trend(points(spark, range(30))).collect()] == list(range(29, 5, -1))


def walked(rows, every):
    """The times kept, one after another over sorted rows."""
    last, kept = {}, []
    for k, t in sorted(set(rows), key=lambda r: (str(r[0]), r[1])):
        if k not in last or t - last[k] >= every:
            last[k] = t
            kept.append((k, t))
    return sorted(kept, key=str)


@pytest.mark.parametrize("every", [1, 7, 60, 100_000])
def test_thinning_of_a_hot_key_against_a_walk(spark, request, every):
    """Most points are of one key, dense, sparse and with gaps wider than a partition; equal times, null keys and null times too."""
    rng = random.Random(every)
    rows, t = [], 0
    for _ in range(1_500):
        t += rng.choice([0, 1, 1, 2, 3, rng.randrange(1, 20), 900 if rng.random() < 0.02 else 1])
        rows.append(("hot", t))
    rows += [(rng.choice(["a", "b", None]), rng.randrange(2_000)) for _ in range(200)] + [("late", 10**10)]
    frame = spark.createDataFrame([*rows, ("hot", None)], "k string, t bigint").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that the hot key lies on several partitions
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    assert sorted(((r.k, r.t) for r in P.sample(frame, "k", "t", every).collect()), key=str) == walked(rows, every)
    assert P.sample(frame.limit(0), "k", "t", every).count() == 0
