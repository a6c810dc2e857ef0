import os

from brandbook.operators.components import connected_components
from brandbook.session import materialise, scratch, shared_root


def folders(spark):
    return set(os.listdir(shared_root(spark).removeprefix("file://")))


def test_scratch_deletes_what_is_not_kept(spark):
    shared_root(spark)
    before = folders(spark)
    with scratch(spark) as keep:
        materialise(spark.range(3), "gone")
        kept = keep(materialise(spark.range(5), "kept"))
    left = folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("kept") and kept.count() == 5


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1500)]
    odd = [(7, 7), (None, 3), (3000, 2999), (2999, 3000)]
    edges = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1500)} == {1000} and got[3000] == got[2999] == 2999
    assert len(got) == 201 + 500 + 2 and connected_components(edges.limit(0)).count() == 0
    words = spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")
    assert {r.component for r in connected_components(words).collect()} == {"a"}
