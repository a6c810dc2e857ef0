import pytest
from pyspark.sql import functions as F

from brandbook.operators import graph as G
from brandbook.plans.read_api import Herd
from tests import herd


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("graph") / "v1")
    Herd.load(herd.frame(spark, herd.SIX)).save(path)
    return Herd.open(spark, path)


def test_reads(loaded):
    shared = {r.uid: r.associations for r in loaded.multi_association().collect()}
    assert shared == {"CHIA:MA430053": ["CHIA", "MAINE"], "CHIA:MA555000": ["CHIA", "SHORT"]}
    assert [r.uid for r in loaded.carriers_of("PHA").collect()] == ["CHIA:MA555000"]
    assert [(r.uid, r.percent) for r in loaded.by_breed("SH", 50).collect()] == [("SHORT:3790685", 100.0), ("CHIA:MA555000", 50.0)]
    a = loaded.get_animal("CHIA:MA555000").first()
    assert [r.association for r in a.registrations] == ["CHIA", "SHORT"] and a.cases == ["AGI-991000"]
    assert [(p.role, p.parent_uid, p.parent_name) for p in a.parents] == [("DAM", "SHORT:S99001", "Big Sky Rose"), ("SIRE", "CHIA:MA430053", "MAB Sherwood Ace 7X")]
    assert {r.uid: r.depth for r in loaded.pedigree("CHIA:MA555000").collect()} == {"SHORT:S99001": 1, "CHIA:MA430053": 1, "SHORT:3790685": 2, "CHIA:400001": 2}
    assert loaded.find("402303").first().uid == "CHIA:MA430053" and loaded.find("sherwood").first().uid == "CHIA:MA430053" and loaded.find("zzz").count() == 0
    assert G.violations(loaded.tables).count() == 0
    assert {r.uid: r.total for r in G.breed_totals(loaded.tables["animal_breed"]).collect()} == {"CHIA:MA430053": 100.0, "SHORT:3790685": 100.0, "CHIA:MA555000": 100.0, "ANGUS:19876543": 100.0}


def lines(spark, pairs):
    return spark.createDataFrame([(c, p, "SIRE" if i % 2 == 0 else "DAM") for i, (c, p) in enumerate(pairs)], "child_uid string, parent_uid string, role string")


def test_pedigree_counts_paths(spark):
    rows = lines(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("k", "a")])
    roots = spark.createDataFrame([("a",)], "uid string")
    got = sorted((r.uid, r.depth) for r in G.pedigree(rows, roots, 3).collect())
    assert got == [("b", 1), ("c", 1), ("d", 2), ("d", 2), ("e", 3), ("e", 3)]
    assert sorted((r.uid, r.depth) for r in G.pedigree_of(spark, rows, "a", 3).collect()) == got
    nodes, edges = G.subgraph(rows, roots, 4)
    assert {r.uid for r in nodes.collect()} == {"a", "b", "c", "d", "e", "k"} and edges.count() == 6
    assert [r.uid for r in G.view(nodes, 2).collect()] == ["a", "b"]
    loop = lines(spark, [("a", "a")])
    assert G.pedigree(loop, roots, 99).count() == 20


def test_merge_fills_gaps_and_moves_edges(spark):
    none = None
    t = {
        "animal": spark.createDataFrame([("A:1", none, "X", "X 1", "", "2001-05-05", none, "Red", none), ("B:2", "I2", "Y", "X 1", "F", "2001-05-05", "T", "Black", none), ("C:3", none, "Z", "Z 9", "S", none, none, none, none)], "uid string, intl_id string, name string, name_norm string, sex string, dob string, tattoo string, color string, horn_status string"),
        "registration": spark.createDataFrame([("A", "1", "A:1", False), ("B", "2", "B:2", True)], "association string, regNumber string, uid string, stub boolean"),
        "animal_dna": spark.createDataFrame([("D", "B:2")], "case_id string, uid string"),
        "animal_breed": spark.createDataFrame([("A:1", "AN", 50.0), ("B:2", "AN", 50.0)], "uid string, breed string, percent double"),
        "animal_defect": spark.createDataFrame([("A:1", "TH", "Free"), ("B:2", "TH", "Carrier")], "uid string, code string, status string"),
        "parentage": spark.createDataFrame([("C:3", "B:2", "DAM"), ("B:2", "B:2", "SIRE"), ("B:2", "A:1", "DAM")], "child_uid string, parent_uid string, role string"),
    }
    out = G.reconcile(t)
    a = {r.uid: r for r in out["animal"].collect()}
    assert set(a) == {"A:1", "C:3"} and (a["A:1"].intl_id, a["A:1"].name, a["A:1"].sex, a["A:1"].color) == ("I2", "X", "F", "Red")
    assert {tuple(r) for r in out["parentage"].collect()} == {("C:3", "A:1", "DAM"), ("A:1", "A:1", "DAM")}
    assert out["animal_breed"].count() == 1 and {r.uid for r in out["registration"].collect()} == {"A:1"}
    assert G.defect_distribution(out["animal_defect"]).count() == 1
    left = G.without_steers(t)
    assert {r.uid for r in left["animal"].collect()} == {"A:1", "B:2"} and left["parentage"].count() == 2
    assert [r.n for r in G.per_association(G.real_registrations(t["registration"], t["animal"])).collect()] == [1]
    dup = t["animal"].union(t["animal"].limit(1))
    assert [r["table"] for r in G.violations({"animal": dup}).collect()] == ["animal"]


def test_upsert_keeps_values_over_nulls(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "k int, v string, w string")
    assert sorted(tuple(r) for r in G.upsert(old, new, ["k"]).select("k", "v", F.coalesce("w", F.lit("-"))).collect()) == [(1, "a", "x"), (2, "b", "z"), (3, "c", "-")]
