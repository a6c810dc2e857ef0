import random

from pyspark.sql import functions as F

from brandbook.operators.ordered import numbered, ordered, running_sums, scanned
from brandbook.operators.progress import sample


def test_order_over_partitions(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(-5, 9)) for i in range(500)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "t bigint, x bigint").repartition(7)
    assert {r.t: r.seq for r in numbered(frame, ["t"]).collect()} == {i: i for i in range(500)}
    sums, total = {}, 0
    for t, x in sorted(rows):
        total += x
        sums[t] = total
    assert {r.t: r.x for r in running_sums(frame, "t", ["x"]).collect()} == sums
    assert running_sums(frame.limit(0), "t", ["x"]).count() == 0 and numbered(frame.limit(0), ["t"]).count() == 0


def test_scans_along_a_key_that_lies_on_many_partitions(spark, request):
    """One key has most rows; values and runs go on over the partitions, and stop where another key begins."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    rng = random.Random(8)
    for share, chance in ((0.9, 0.9), (0.3, 0.5), (0.5, 1.0)):
        rows = [(None if rng.random() < 0.1 else "hot" if rng.random() < share else rng.choice("abc"), i, rng.choice([None, 1, 2, 3]), rng.random() < chance) for i in range(400)]
        frame = spark.createDataFrame(rows, "k string, t int, x int, f boolean").repartition(5)
        want, before, run = {}, {}, {}
        for k, t, x, f in rows:
            run[k] = run.get(k, 0) + 1 if f else 0
            want[t] = (before.get(k), run[k])
            before[k] = x
        got = scanned(frame.repartition(9), "k", ["t"], ("x",), F.col("f"))
        assert got.columns == ["k", "t", "x", "f", "prev_x", "run"]
        assert {r.t: (r.prev_x, r.run) for r in got.collect()} == want
        assert {r.t: r.prev_x for r in scanned(frame, "k", ["t"], ("x",)).collect()} == {t: w[0] for t, w in want.items()}
    assert scanned(frame.limit(0), "k", ["t"], ("x",), F.col("f")).count() == 0


def test_one_hot_key_runs_on_all_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which puts tables as small as this in one
    try:
        frame = spark.range(4_000).select(F.lit("one").alias("k"), F.col("id").alias("t"), F.lit(True).alias("f"))
        sizes = [r["count"] for r in ordered(frame, ["k", "t"]).groupBy("_part").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2_000
        assert [r.run for r in scanned(frame, "k", ["t"], flag=F.col("f")).orderBy("t").collect()] == list(range(1, 4_001))
        assert [r.t for r in sample(frame, "k", "t", 7).orderBy("t").collect()] == list(range(0, 4_000, 7))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
