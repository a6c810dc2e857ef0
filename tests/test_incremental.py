import json
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from brandbook.operators import resolve as R
from brandbook.operators.block_index import BlockIndex
from brandbook.plans.read_api import Herd
from brandbook.session import published
from brandbook.sources import records
from brandbook.streaming import tail
from tests import herd


def rows(df, *fields):
    return sorted(str(tuple(r[f] for f in fields)) for r in df.collect())


KEPT = (
    ("animal", ["uid", *R.FIELDS]), ("registration", ["association", "regNumber", "uid", "stub", "via_cross_ref"]), ("animal_defect", ["uid", "code", "status"]),
    ("animal_dna", ["case_id", "uid"]), ("animal_breed", ["uid", "breed", "percent"]), ("mention", ["mention", "uid"]), ("parentage", ["child_uid", "parent_uid", "role"]),
)


def same(got, want):
    for name, fields in KEPT:
        assert rows(got[name], *fields) == rows(want[name], *fields), name


def spaced(rng, n, herds):
    """Random records in some namespaces, so that there are several blocks; namespace 0 is bridged to others."""
    for i, r in enumerate(herd.random_records(rng, n)):
        k = i % herds
        yield dict(r, association=f"{r['association']}{k}", tattoo=r["tattoo"] and f"{r['tattoo']}{k}", name=r["name"] and f"{r['name']} {k}", intl_id=r["intl_id"] and f"{r['intl_id']}{rng.choice([k, 0])}", sire=None if rng.random() < 0.5 else r["sire"])


def test_loads_equal_a_replay_of_all(spark, tmp_path):
    rng = random.Random(21)
    every = list(spaced(rng, 60, 12))
    frame = herd.frame(spark, every).withColumnRenamed("seq", "at")
    index, cuts = BlockIndex(spark, str(tmp_path / "i"), buckets=4), [0, 25, 45, 60]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        index.add(frame.where(F.col("at").between(a, b - 1)), batch, ["at"])
    want = R.replay(herd.frame(spark, every))
    same(index.tables(2), want)
    same(index.tables(1), R.replay(herd.frame(spark, every[:45])))
    assert index._rows("status", 2).where("block <> into").count() > 0, "old blocks were joined"
    small = index.compacted(str(tmp_path / "c"), 1)  # goes on without the last load, which comes again
    small.add(frame.where("at >= 45"), 2, ["at"])
    same(small.tables(2), want)


def test_a_load_reads_only_what_it_touches(spark, tmp_path):
    """A record of one herd of fifty: one block's facts and bodies are written again, the others stay where they are."""
    index = BlockIndex(spark, str(tmp_path / "i"), buckets=8)
    many = [herd.record("A", str(i), f"NAME {i} X", dob="2001-01-01", sex="M", intl_id=f"I{i}") for i in range(50)]
    index.add(herd.frame(spark, many).withColumnRenamed("seq", "at"), 0, ["at"])
    index.add(herd.frame(spark, [herd.record("B", "7", "NAME 7 X", intl_id="I7")]).withColumnRenamed("seq", "at"), 1, ["at"])
    assert [(r.block, r.mention) for r in index._rows("mentions", 1).where("batch = 1").orderBy("mention").collect()] == [(21, 21), (21, 150)]
    assert index._rows("animal", 1).where("batch = 1").count() == 1 and index.tables(1)["animal"].count() == 50


def test_a_growing_file_keeps_the_graph_up_to_date(spark, tmp_path):
    file, graph = tmp_path / "a.jsonl", str(tmp_path / "graph")
    file.write_text("")
    for part in (herd.SIX[:3], herd.SIX[3:], []):
        with file.open("a") as out:
            out.writelines(json.dumps(r) + "\n" for r in part)
        tail.follow(spark, [str(file)], tail.load_graph(graph), str(tmp_path / "ck"), once=True)
    want = R.replay(herd.frame(spark, herd.SIX))
    same(Herd.current(spark, graph).tables | {"mention": want["mention"]}, want)
    assert published(spark, graph).endswith("e0/v-1")
    tail.compact(spark, graph)
    same(Herd.current(spark, graph).tables | {"mention": want["mention"]}, want)
    assert tail.current_epoch(spark, graph) != "e0"


def test_a_rebuild_is_seen_when_it_is_whole(spark, tmp_path, monkeypatch):
    file, graph = tmp_path / "a.jsonl", str(tmp_path / "graph")
    file.write_text("".join(json.dumps(r) + "\n" for r in herd.SIX[:2]))
    tail.follow(spark, [str(file)], tail.load_graph(graph), str(tmp_path / "ck"), once=True)
    old = Herd.current(spark, graph)
    before, was = old.tables["animal"].count(), published(spark, graph)
    file.write_text("".join(json.dumps(r) + "\n" for r in herd.SIX[2:]))
    add = BlockIndex.add

    def killed(self, records, batch, *rest, **options):
        add(self, records, batch, *rest, **options)
        raise RuntimeError("killed once the load was written")

    monkeypatch.setattr(BlockIndex, "add", killed)
    with pytest.raises(Exception, match="killed"):
        tail.rebuild(spark, [str(file)], graph)
    assert published(spark, graph) == was and old.tables["animal"].count() == before
    monkeypatch.setattr(BlockIndex, "add", add)
    shadow = published(spark, f"{graph}/_rebuild").rsplit("/", 1)[1]
    epoch = tail.rebuild(spark, [str(file)], graph)
    assert epoch == shadow and published(spark, graph) == f"{graph}/{epoch}/v-0" and published(spark, f"{graph}/_rebuild") is None
    want = R.replay(herd.frame(spark, herd.SIX[2:]))
    same(Herd.current(spark, graph).tables | {"mention": want["mention"]}, want)
    assert old.tables["animal"].count() == before


def test_snapshots_are_whole(spark, tmp_path):
    path = str(tmp_path / "s")
    assert records.read_snapshot(spark, path, "id bigint").count() == 0
    for n in (3, 5, 7):
        records.snapshot(spark.range(n), path)
        assert records.read_snapshot(spark, path, "id bigint").count() == n
    assert len([p for p in (tmp_path / "s").iterdir() if p.is_dir()]) == 2


def test_the_schema_verb():
    said = subprocess.run([sys.executable, "-m", "brandbook", "schema"], capture_output=True, text=True, timeout=120)
    assert "animal: uid string" in said.stdout and "parentage" in said.stdout
