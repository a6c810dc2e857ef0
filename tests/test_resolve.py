import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brandbook.operators import resolve as R
from brandbook.plans import catalogue_records
from brandbook.session import materialise
from tests import herd


def load(spark, records, **options):
    return R.replay(herd.frame(spark, records), **options)


def uids(tables):
    return {r.uid for r in tables["animal"].collect()}


def test_six_records(spark):
    t = load(spark, herd.SIX)
    assert uids(t) == {"CHIA:MA430053", "SHORT:3790685", "CHIA:400001", "CHIA:MA555000", "SHORT:S99001", "ANGUS:19876543"}
    assert {r.rung: r.n for r in R.stats(t).collect()} == {"created": 6, "intl_id": 2, "dna": 1}
    papers = {(r.association, r.regNumber): r for r in t["registration"].collect()}
    assert len(papers) == 8 and {k for k, r in papers.items() if r.stub} == {("CHIA", "400001"), ("SHORT", "S99001")}
    assert papers["MAINE", "402303"].stub is False and papers["MAINE", "402303"].via_cross_ref is True
    assert [t[k].count() for k in ("parentage", "animal_dna", "animal_breed", "animal_defect")] == [4, 4, 7, 13]
    assert [r.uid for r in t["animal_defect"].where("code = 'PHA' and status = 'Carrier'").collect()] == ["CHIA:MA555000"]


def test_seven_records_and_reload(spark):
    t = load(spark, herd.SEVEN)
    owner = Counter(r.uid for r in t["registration"].collect())
    assert len(uids(t)) == 4 and owner["CHIA:337003"] == 2 and owner["CHIA:MA430053"] == 2
    assert uids(load(spark, herd.SEVEN * 2)) == uids(t)


@pytest.mark.parametrize("records", [herd.CALF_FIRST, herd.CALF_LAST])
def test_a_parent_seen_before_or_after_is_one_animal(spark, records):
    t = load(spark, records)
    jenna = [r.uid for r in t["animal"].where(f"name_norm = '{herd.JENNA}'").collect()]
    papers = {f"{r.association}:{r.regNumber}" for r in t["registration"].collect() if r.uid in jenna}
    assert len(jenna) == 1 and papers == {"CHIA:337003", "MAINE:378987"}


def test_steers(spark):
    records = [*herd.SEVEN, herd.record("CHIA", "S1", "STEER 1", sex="S")]
    assert "CHIA:S1" not in uids(load(spark, records, skip_steers=True)) and "CHIA:S1" in uids(load(spark, records))


def model(spark, records):
    """The same records read one by one by the slow model."""
    m = herd.Model()
    for r in sorted(R.prepared(herd.frame(spark, records)).collect(), key=lambda r: r.seq):
        m.record(r.asDict(recursive=True))
    return m


def test_blocks_equal_the_sequential_run(spark):
    rng = random.Random(11)
    sets = [list(herd.random_records(rng, rng.randrange(4, 10))) for _ in range(25)]
    # as one table, each set in a namespace of its own, so that there are many blocks
    spaced = []
    for i, records in enumerate(sets):
        mark = lambda v, i=i: f"{v}{i:02d}" if v else v
        for r in records:
            r = dict(r, association=mark(r["association"]), intl_id=mark(r["intl_id"]), tattoo=mark(r["tattoo"]), name=mark(r["name"]) if r["name"] != "ANGUS" else "ANGUS", dna_cases=[mark(c.strip()) for c in r["dna_cases"]])
            r["cross_refs"] = [dict(x, association=mark(x["association"])) for x in r["cross_refs"]]
            for role in ("sire", "dam"):
                if r[role]:
                    r[role] = dict(r[role], association=mark(r[role]["association"]), intl_id=mark(r[role]["intl_id"]), name=mark(r[role]["name"]) if r[role]["name"] != "ANGUS" else "ANGUS")
            spaced.append(r)
    rng.shuffle(spaced)
    m = model(spark, spaced)
    want = m.tables()
    t = load(spark, spaced)
    for kind, fields in (("animal", ["uid", *R.FIELDS]), ("animal_defect", ["uid", "code", "status"]), ("animal_dna", ["case_id", "uid"]), ("animal_breed", ["uid", "breed", "percent"]), ("registration", ["association", "regNumber", "uid", "stub", "via_cross_ref"]), ("mention", ["mention", "uid"]), ("parentage", ["child_uid", "parent_uid", "role"])):
        assert sorted(str(tuple(r[f] for f in fields)) for r in t[kind].collect()) == sorted(map(str, want[kind])), kind
    assert {r.rung: r.n for r in R.stats(t).collect()} == Counter(m.rungs)
    assert R.mention_blocks(R.prepared(herd.frame(spark, spaced))).select("block").distinct().count() > 25


def test_values_of_several_records_meet(spark):
    """Tattoo, birth date and sex from three records of one animal find a fourth; a stub's name is swept up."""
    rec = herd.record
    records = [
        rec("A", "1", "ONE A 1", intl_id="I", tattoo="T"), rec("B", "2", None, intl_id="I", dob="2001-01-02"), rec("C", "3", None, intl_id="I", sex="M"), rec("D", "4", "OTHER B 2", tattoo="T", dob="2001-01-02", sex="M"),
        rec("E", "5", "CALF", dam=herd.parent("F", "6", "LATE COW 7")), rec("G", "8", "LATE COW 7", dob="2002-01-01"), rec("H", "9", "SIRE C 3", sex="M", dob="2000-01-01"), *(rec("Z", str(i), f"YOUNG {i}A", sire=herd.parent("H", "9", "SIRE C 3")) for i in range(40)),
    ]
    t, m = load(spark, records), model(spark, records)
    assert sorted((r.uid, r.name_norm) for r in t["animal"].collect()) == sorted((a.uid, a.values["name_norm"]) for a in m.animals)
    assert {r.rung: r.n for r in R.stats(t).collect()} == Counter(m.rungs) and len(m.animals) == 44
    assert sum(r.parent_uid == "H:9" for r in t["parentage"].collect()) == 40


def test_closure(spark):
    keys = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (9, "z"), (7, None)], "mention long, key string")
    assert {r.mention: r.entity for r in R.closure(keys).collect()} == {1: 1, 2: 1, 3: 1, 9: 9}


def plain_links(placed, listed):
    return {tuple(r) for r in R.connected_components(R.weak_links(placed, listed)).collect()}


def test_wide_blocks_join_as_listed_ones_do(spark):
    rng = random.Random(5)
    pick = lambda *xs: rng.choice([None, *xs])
    for _ in range(2):
        rows = [(rng.randrange(14), pick("T1", "T2", "T3", "T4"), pick("d1", "d2", "d3", "d4"), pick("M", "F"), pick("n1", "n2", "n3", "n4", "n5", "n6"), False, False) for _ in range(34)]
        placed = spark.createDataFrame(rows, "block long, tattoo string, dob string, sex string, name string, specific boolean, dated boolean").distinct()
        assert plain_links(placed, 10**9) == plain_links(placed, 2)


def test_a_junk_key_makes_no_product(spark):
    """Two blocks of 50,000 names and 10,000 dates each, which list 500 million combinations apiece, and narrow ones beside them."""
    schema = "block long, tattoo string, dob string, sex string, name string, specific boolean, dated boolean"
    junk = spark.range(100_000).select((F.col("id") % 2).alias("block"), F.lit(None).cast("string"), F.concat(F.lit("d"), F.expr("id div 10")), F.lit("M"), F.concat(F.lit("n"), F.expr("id div 2")), F.lit(False), F.lit(True))
    near = spark.createDataFrame([(5, None, "d17", None, "n400", False, False), (6, None, "d18", None, "other", False, False), (7, None, "never", None, "n400", False, False)], schema)
    placed = materialise(junk.union(near).toDF(*near.columns), "placed")
    found = materialise(R.weak_links(placed), "links")
    assert found.count() < 10 and plain_links(placed, R.LISTED) == {(0, 0), (1, 0), (5, 0)}


def test_blocks_share_batches():
    body = {**dict.fromkeys(("name", "norm", "intl", "sex", "dob", "tattoo", "color", "horn", "breeder", "owner", "epds", "attributes", "source_url", "scraped_at")), "generic": False, "specific": False, "cases": [], "xrefs": [], "breeds": [], "defects": [], "assoc": "A"}
    told = [(k, 3 * k, json.dumps({**body, "seq": k, "reg": f"R{k}"})) for k in range(4000)]
    wide = [(4000, 3 * k, json.dumps({**body, "seq": k, "reg": f"W{k}"})) for k in range(4000, 4000 + R.OUT_ROWS)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["block", "mention", "body"]) for rows in (told[:2500], told[2500:] + wide)]
    out = list(R._replay_sorted(batches))
    rows = [r for b in out for r in b.to_pylist()]
    assert Counter(r["kind"] for r in rows) == dict.fromkeys(("log", "mention", "animal", "registration"), 4000 + R.OUT_ROWS)
    assert {r["block"] for r in rows if r["kind"] == "animal" and json.loads(r["payload"])["uid"].startswith("A:W")} == {4000}
    assert all(json.loads(r["payload"])["mention"] == 3 * r["block"] for r in rows if r["kind"] == "mention" and r["block"] < 4000)
    # not a batch a block, and none without end
    assert all(R.OUT_ROWS <= b.num_rows < 2 * R.OUT_ROWS for b in out[:-1])


@pytest.mark.parametrize("name", ["resolve_ladder", "resolve_stats"])
def test_records_of_a_small_file_are_made_by_many_tasks(spark, tmp_path, monkeypatch, name):
    spark.range(2000).selectExpr("id as c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")

    class Seen(Exception):
        pass

    def replay(records):
        raise Seen(records.select(F.spark_partition_id()).distinct().count())

    monkeypatch.setattr(R, "replay", replay)
    with pytest.raises(Seen) as seen:
        getattr(catalogue_records, name)(spark, str(tmp_path))
    assert seen.value.args[0] == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
