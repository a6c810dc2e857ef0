import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from brandbook.operators import frontier as Q
from brandbook.schema import FRONTIER
from brandbook.sources import records as S
from brandbook.streaming import heartbeat, queue, tail

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


@pytest.fixture
def replayed(spark, tmp_path):
    """A function that streams batches of outcomes, one file each, and gives all rows that come out."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    queue.ready(spark)

    def run(batches, made, name):
        folder, out = str(tmp_path / name), []
        for n, batch in enumerate(batches):
            spark.createDataFrame(batch, queue.OUTCOME).coalesce(1).write.mode("append").parquet(folder)
            stream = spark.readStream.schema(queue.OUTCOME).parquet(folder)
            query = made(stream).writeStream.outputMode("append").option("checkpointLocation", f"{folder}-ck").foreachBatch(lambda df, _: out.extend(df.collect())).trigger(availableNow=True).start()
            query.awaitTermination(180)
        return out

    yield run
    spark.conf.set(provider, before)


def outcomes(rng, batches):
    clock = 0
    for _ in range(batches):
        rows = []
        for reg in rng.sample("123456", rng.randrange(2, 5)):
            clock += rng.randrange(1, 40)
            assoc = "AB"[reg > "3"]
            rows.append((assoc, reg, rng.choice(["done", "skipped", "failed", "failed", "refused", "refused"]), "why " * 200, rng.choice([None, None, 7]), at(clock)))
        yield rows


def test_the_stream_equals_the_table(spark, replayed):
    rng = random.Random(5)
    seeds = [("AB"[reg > "3"], reg, "seed", None, None, at(0)) for reg in "123456"]
    batches = [seeds, *outcomes(rng, 3)]
    table = spark.createDataFrame([(a, r, "pending", 0, 0, 0, None, None, None) for a, r, *_ in seeds], FRONTIER)
    for rows in batches[1:]:
        table = spark.createDataFrame(Q.visited(table, spark.createDataFrame(rows, queue.OUTCOME), F.lit("now")).collect(), FRONTIER)
    last = {}
    for r in replayed(batches, lambda s: queue.entries(s, keep=10**6), "entries"):
        last[r.association, r.reg_number] = (r.status, r.attempts, r.last_error)
    assert last == {(r.association, r.reg_number): (r.status, r.attempts, r.last_error) for r in table.collect()}

    visits = spark.createDataFrame([row for rows in batches[1:] for row in rows], queue.OUTCOME)
    want = Q.refusal_streaks(visits, "association", ["at"], F.col("outcome") == "refused", F.col("retry_after")).collect()
    got = replayed(batches, queue.hosts, "hosts")
    assert sorted((r.association, r.at, r.streak, r.wait, r.stop) for r in got if r.kind == "visit") == sorted((r.association, r.at, r.streak, r.wait, r.stop) for r in want)
    waits = {(r.association, r.at + dt.timedelta(seconds=r.wait)) for r in got if r.kind == "visit" and r.wait}
    rung = [(r.association, r.at) for r in got if r.kind == "resume"]
    assert len(set(rung)) == len(rung) and set(rung) <= waits


def test_timers(spark, replayed):
    """A wait ends once event time has passed it, unless a visit came first; an entry that is done is forgotten after its time."""
    rows = lambda *xs: [("A", "1", o, None, after, at(s)) for o, after, s in xs]
    other = [("Z", "9", "done", None, None, at(500))]
    got = replayed([rows(("refused", None, 0), ("refused", 100, 10)), other], queue.hosts, "waits")
    assert [(r.at, r.streak) for r in got if r.kind == "resume"] == [(at(110), 2)]
    again = [("A", "1", "failed", "late", None, at(900))]
    far = [("Z", "9", "failed", None, None, at(800))]
    got = replayed([rows(("failed", None, 0), ("done", None, 10)), other, far, again], lambda s: queue.entries(s, keep=200), "kept")
    assert [(r.status, r.attempts) for r in got if r.association == "A"] == [("pending", 1), ("done", 1), ("pending", 1)]


def test_a_heartbeat_is_read_while_a_tail_runs(spark, tmp_path):
    path, file = str(tmp_path / "status_A.json"), tmp_path / "a.jsonl"
    file.write_text('{"association": "A", "regNumber": "1"}\n')
    beat = heartbeat.listened(spark, path, "A", "tail of A")
    told = lambda: (S.read_status(spark, path).collect() or [None])[0] if (tmp_path / "status_A.json").exists() else None

    def wait(until):
        for _ in range(120):
            if (r := told()) and until(r):
                return r
            time.sleep(0.5)
        raise AssertionError(f"the heartbeat says {told()}")

    try:
        query = tail.follow(spark, [str(file)], tail.store(str(tmp_path / "store")), str(tmp_path / "ck"), every="1 seconds", name="tail of A")
        assert wait(lambda r: r.processed == 1).state == "running" and query.isActive
        with file.open("a") as out:
            out.write('{"association": "A", "regNumber": "2"}\nbad\n')
        r = wait(lambda r: r.processed == 3)
        assert r.counts["rows"] == 2 and r.rate_per_min > 0 and query.isActive
        query.stop()
        assert wait(lambda r: r.state == "stopped").processed == 3
    finally:
        spark.streams.removeListener(beat)
