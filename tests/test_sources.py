import json
import os
import random

from pyspark.sql import functions as F

from brandbook.plans.read_api import Herd
from brandbook.sources import archive as A
from brandbook.sources import records as S
from brandbook.streaming import history, tail
from tests import herd


def jsonl(path, records, extra=""):
    path.write_text("".join(json.dumps(r) + "\n" for r in records) + extra)


def test_records_keep_their_order(spark, tmp_path):
    jsonl(tmp_path / "a.jsonl", herd.SIX, '\n  \n{"association": "CHIA", broken\n[1]\n')
    got = S.read_records(spark, str(tmp_path / "a.jsonl")).orderBy("seq").collect()
    assert [r.regNumber for r in got] == [r["regNumber"] for r in herd.SIX] and [r.seq for r in got] == list(range(6))
    assert [(r.lines, r.bad) for r in S.malformed(spark, str(tmp_path / "a.jsonl")).collect()] == [(8, 2)]
    (tmp_path / "b.json").write_text(json.dumps(herd.SIX[:2]))
    (tmp_path / "c.json").write_text(json.dumps(herd.SIX[3]))
    got = S.read_records(spark, [str(tmp_path / "b.json"), str(tmp_path / "c.json")], array=True).orderBy("seq").collect()
    assert [r.regNumber for r in got] == ["MA430053", "402303", "MA555000"]
    assert {r.association: r.n for r in S.loadable(S.read_records(spark, str(tmp_path / "a.jsonl"))).collect()} == {"CHIA": 2, "MAINE": 1, "SHORT": 2, "ANGUS": 1}
    S.append_records(S.read_records(spark, str(tmp_path / "a.jsonl")), str(tmp_path / "out"))
    S.append_records(S.read_records(spark, str(tmp_path / "a.jsonl")), str(tmp_path / "out"))
    assert S.read_records(spark, str(tmp_path / "out")).count() == 12


def test_seeds_status_scripts(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# all\nMAINE:5\n\n7 # own\n")
    assert {(r.association, r.reg_number, r.priority) for r in S.read_seeds(spark, str(tmp_path / "seeds.txt"), "chia", 2).collect()} == {("MAINE", "5", 2), ("CHIA", "7", 2)}
    assert [r.reg_number for r in S.enumerated(spark, "chia", 3, 5).collect()] == ["3", "4", "5"]
    (tmp_path / "status_A.json").write_text('{"association": "A", "counts": {"done": 3}, "pid": 4}')
    (tmp_path / "status_B.json").write_text('{"association": ')
    assert [(r.association, r.counts) for r in S.read_status(spark, str(tmp_path / "status_*.json")).collect()] == [("A", {"done": 3})]
    script = spark.createDataFrame([("// head\nCREATE  X\n a; // tail\n ;CREATE Y;",)], "s string")
    assert script.select(S.statements(F.col("s")).alias("x")).first().x == ["CREATE X a", "CREATE Y"]
    old = spark.createDataFrame([("A", "1")], "association string, reg_number string")
    row = S.migrated_frontier(old).first()
    assert (row.status, row.priority, row.attempts) == ("pending", 0, 0) and S.empty_frontier(spark).count() == 0
    S.snapshot(old, str(tmp_path / "snap"))
    S.snapshot(old, str(tmp_path / "snap"))
    assert S.read_snapshot(spark, str(tmp_path / "snap"), "association string, reg_number string").count() == 1
    assert S.dim_association(spark).where("code = 'CHIA'").first().prefix == "ACA" and S.dim_breed_tokens(spark).count() == 30


def test_archive(spark, tmp_path):
    pages = spark.createDataFrame([("chia", "MA1", "container", "<a>"), ("CHIA", "MA2", "pedigree", "<b>"), ("MAINE", "9", "container", "<c>")], "association string, reg string, suffix string, html string")
    A.save(pages, str(tmp_path / "a"))
    A.save(pages.limit(1).withColumn("html", F.lit("<new>")), str(tmp_path / "a"))
    assert A.load(spark, str(tmp_path / "a"), "CHIA", "MA1", "container").first().html == "<new>"
    assert A.scan(spark, str(tmp_path / "a"), "chia", ["pedigree"]).count() == 1
    wanted = spark.createDataFrame([("CHIA", "MA1", "container"), ("CHIA", "MA9", "container")], "association string, reg string, suffix string")
    assert [r.reg for r in A.missing(wanted, spark, str(tmp_path / "a")).collect()] == ["MA9"]
    (tmp_path / "CHIA_MA_1_pedigree.html").write_text("<p>")
    assert [tuple(r)[:3] for r in A.read_files(spark, str(tmp_path / "*.html")).collect()] == [("CHIA", "MA_1", "pedigree")]
    assert {r.name for r in spark.read.json(A.write_files(pages.limit(1))).collect()} == {"chia_MA1_container.html"}


def test_tail_takes_whole_lines_once(spark, tmp_path):
    path = tmp_path / "data.jsonl"
    jsonl(path, herd.SIX[:2], '{"association": "SH')
    whole = tail.whole_until(str(path), path.stat().st_size)
    assert path.read_bytes()[whole:] == b'{"association": "SH' and len(list(tail.lines_between(str(path), 0, whole))) == 2
    run = lambda: tail.follow(spark, [str(path)], tail.store(str(tmp_path / "store")), str(tmp_path / "check"), once=True).awaitTermination(120)
    run()
    assert [r.regNumber for r in tail.stored(spark, str(tmp_path / "store")).orderBy("seq").collect()] == ["MA430053", "402303"]
    with open(path, "a") as file:
        file.write('ORT", "regNumber": "S1"}\nnot json\n' + json.dumps(herd.SIX[3]) + "\n")
    run()
    rows = tail.stored(spark, str(tmp_path / "store"))
    assert [r.regNumber for r in rows.orderBy("seq").collect()] == ["MA430053", "402303", "S1", "MA555000"]
    assert Herd.load(rows).tables["animal"].count() == 6
    jsonl(path, herd.SIX[5:])  # shrunk: from the first byte again
    run()
    assert [r.regNumber for r in tail.stored(spark, str(tmp_path / "store")).orderBy("seq").collect()][4:] == ["19876543"]


def test_tail_ranges_hold_each_line_once(tmp_path):
    rng = random.Random(3)
    path = tmp_path / "x.jsonl"
    lines = [rng.choice(["", " ", "a" * rng.randrange(1, 90), "é漢" * rng.randrange(1, 9)]) for _ in range(300)]
    path.write_text("".join(x + "\n" for x in lines) + "part")
    whole = tail.whole_until(str(path), path.stat().st_size)
    for size in (1, 7, 64, 1000, 1 << 20):
        reader = tail.TailReader({"path": f"{path},{tmp_path / 'none'}", "partbytes": str(size)})
        end = reader.latestOffset()
        assert end == {str(path): whole, str(tmp_path / "none"): 0}
        parts = reader.partitions(reader.initialOffset(), end)
        assert len(parts) == -(-whole // size)
        found = [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
        assert [r["value"] for r in found] == [x for x in lines if x.strip()]
        data = path.read_bytes()
        assert all(data[r["at"] :].startswith(r["value"].encode() + b"\n") for r in found)


def test_tail_of_several_files_is_read_by_tasks(spark, tmp_path):
    paths = []
    for n in range(3):
        paths.append(f"file://{tmp_path}/f{n}.jsonl")
        (tmp_path / f"f{n}.jsonl").write_text("\n" * 12 + "".join(json.dumps({**herd.SIX[0], "regNumber": f"N{n}{i:02d}"}) + "\n" for i in range(25)))
    tasks = []

    def sink(records, batch_id):
        tasks.append(records.select(F.spark_partition_id()).distinct().count())
        tail.store(str(tmp_path / "store"))(records, batch_id)

    tail.follow(spark, paths, sink, str(tmp_path / "check"), once=True, part_bytes=2000).awaitTermination(120)
    assert [r.regNumber for r in tail.stored(spark, str(tmp_path / "store")).orderBy("seq").collect()] == [f"N{n}{i:02d}" for n in range(3) for i in range(25)]
    assert tasks[0] > 3


def test_counts_read_only_what_changed(spark, tmp_path):
    """Files whose bytes change behind an equal size and time keep their counts: they weren't read."""
    a, b, manifest = tmp_path / "a.jsonl", tmp_path / "b.jsonl", str(tmp_path / "manifest")
    jsonl(a, herd.SIX[:3])
    jsonl(b, [*herd.SIX[3:5], {**herd.SIX[3], "sex": "s", "regNumber": "steer"}, herd.SIX[3]], "not json\n")
    told = lambda: {(r.file.rsplit("/", 1)[1], r.association): r.n for r in S.counted(spark, str(tmp_path / "*.jsonl"), manifest).collect()}
    first = {("a.jsonl", "CHIA"): 1, ("a.jsonl", "MAINE"): 1, ("a.jsonl", "SHORT"): 1, ("b.jsonl", "CHIA"): 1, ("b.jsonl", "SHORT"): 1}
    assert told() == first
    version = (tmp_path / "manifest" / "_current").read_text()
    when = a.stat().st_mtime_ns
    a.write_bytes(b"x" * a.stat().st_size)
    os.utime(a, ns=(when, when))
    assert told() == first and (tmp_path / "manifest" / "_current").read_text() == version
    with b.open("a") as out:
        out.write(json.dumps(herd.SIX[5]) + "\n")
    assert told() == first | {("b.jsonl", "ANGUS"): 1}
    a.unlink()
    assert told() == {k: n for k, n in first.items() if k[0] == "b.jsonl"} | {("b.jsonl", "ANGUS"): 1}


def test_history_stream(spark, tmp_path):
    schema = "association string, t bigint, done bigint, pending bigint"
    src = str(tmp_path / "in")
    batches = [[("A", 0, 1, 1), ("A", 30, 2, 1), ("B", 5, 1, 1), ("B", 0, 1, 1)], [("A", 660, 3, 0), ("A", 20, 9, 9), (None, 5, 1, 1)], [("B", 300, 2, 2), ("B", 700, 3, 3)]]
    out = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = history.sampled(spark.readStream.schema(schema).parquet(src))
        query = stream.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(lambda df, _: out.extend(df.collect())).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert sorted((r.association, r.t) for r in out) == [("A", 0), ("A", 660), ("B", 0)]
    beats = spark.readStream.schema("association string, at timestamp").parquet(src)
    assert history.stale(beats).isStreaming
