"""SimHash near-duplicates by covering locality-sensitive hashing.

*Fingerprint.* A text's ASCII letters are lower-cased and split on ASCII white space; each shingle of three
words (repeats included, joined by one space; a shorter text is one shingle) is hashed with XXH64, seed 42.
A bit of the 64-bit fingerprint is set if it is set in more than half the hashes. No words: zero.

*Candidates.* With radius r, every bit position gets a non-zero vector m(i) of r+1 bits and every non-zero
vector v of r+1 bits gives one table, whose key keeps the positions with an odd inner product of v and m(i).
Any r positions have some v orthogonal to all their vectors, so two fingerprints that differ in r bits or
fewer have equal keys in some table: no pair within the radius is missed.

*Links.* Equal fingerprints are one row from the start, so copies never make pairs. A bucket with at most
``direct`` different fingerprints is compared pair by pair. The members of larger buckets are linked by
another exact way that never makes pairs: each emits its own value and all values one bit away (radius 1) or,
for radius 2, the same 65 values, and members that share a value are within two bits of each other; the
least member of a value links to the others. Both ways are exact and neither drops anything.

*Groups.* ``connected_components`` over the links between different fingerprints.

*By similarity* (``similar``). Where near-duplicates are texts whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more, they differ in some ten of 64 bits, and a covering of that radius takes 2,047 tables.
So the covering finds the pairs within ``radius`` bits, an exact comparison of the sets confirms them, and what is
confirmed is one part. The links between parts are found by ``jaccard.links``, exactly too: no pair is lost.

Edge cases: a null or empty text has fingerprint zero (and the empty set) and is linked like any other; rows
without ``doc_id`` take part and get their group's id, which is null if no member has one; repeated rows stay
repeated; a text's length isn't limited; an empty table gives no rows; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.llm import jaccard
from brandbook.llm.arrow import row_map
from brandbook.llm.joins import bounded
from brandbook.llm.shingles import BITS, SEED, set_name, shingle_hashes, shingle_set, signed, simhash
from brandbook.operators.components import connected_components
from brandbook.session import materialise

SHINGLE = 3
#: Words of a shingle where groups are by similarity.
SET_SHINGLE = 5
#: Texts of the sample, how many of them have a common shingle, and how many common shingles are known.
SAMPLE, COMMON, MOST_COMMON = 20_000, 2, 1_000_000


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    return simhash(shingle_hashes(text, size))


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 masks, as signed 64-bit integers; positions take the vectors in turn."""
    vectors = (1 << (radius + 1)) - 1
    # 5 has no common factor with 7 or 3, so neighbouring bits get vectors apart from each other
    at = [(5 * i + i // vectors) % vectors + 1 for i in range(BITS)]
    return [signed(sum(1 << i for i in range(BITS) if (at[i] & v).bit_count() % 2)) for v in range(1, vectors + 1)]


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)``, fp the fingerprint as a signed long."""
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    run = row_map("text", lambda: lambda t: (signed(fingerprint(t)),), ["fp"], [pa.int64()])
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(values: DataFrame, radius: int = 2, direct: int = 32) -> DataFrame:
    """Edges ``(a, b)`` that connect the different values ``fp`` within ``radius`` bits (1 or 2)."""
    if radius not in (1, 2):
        raise ValueError("the exact way for large buckets covers radius 1 and 2")
    keys = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(covering_masks(radius))]
    entries = values.select("fp", F.explode(F.array(*keys)).alias("e")).select("fp", "e.t", "e.k")
    sizes = materialise(entries.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = materialise(entries.join(sizes, ["t", "k"]), "shared")

    small = shared.where(F.col("n") <= direct).groupBy("t", "k").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = (
        small.select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode(F.filter("fps", lambda b: (b > F.col("a")) & (_distance(b, F.col("a")) <= radius))).alias("b"))
    )

    crowd = shared.where(F.col("n") > direct).select("fp").distinct()
    near = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    values_near = crowd.select("fp", F.explode(F.concat(F.array("fp"), near)).alias("k"))
    stars = values_near.groupBy("k").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("k", "a")
    by_star = values_near.join(stars, "k").where("fp <> a").select("a", F.col("fp").alias("b")).where(_distance(F.col("a"), F.col("b")) <= radius)
    if radius == 1:
        # two values at distance two share a star without being linked, so a star's least member proves nothing
        by_star = values_near.join(crowd.select(F.col("fp").alias("k"), F.col("fp").alias("b")), "k").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(by_star)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 2, direct: int = 32) -> DataFrame:
    """``(doc_id, fingerprint, component_id, group)`` for every row of ``docs``; see the module's text. group
    is a fingerprint that names the group, also where ids repeat or are missing."""
    slim = materialise(fingerprints(docs, text, key), "fingerprints")
    classes = materialise(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    labels = grouped(classes, links(classes.select("fp"), radius, direct))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return slim.join(labels, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id", "group", "fp")


def grouped(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(fp, component_id, group)`` of ``classes(fp, least)`` linked by ``edges(a, b)``."""
    groups = materialise(connected_components(edges), "groups")
    placed = materialise(groups.join(classes, groups.node == classes.fp).select("fp", "component", "least"), "placed")
    roots = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = placed.join(roots, "component").select("fp", "component_id", F.col("component").alias("group"))
    alone = classes.join(placed.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"), F.col("fp").alias("group"))
    return materialise(linked.union(alone), "labels")


def common(docs: DataFrame, text: str = "text", size: int = SET_SHINGLE) -> np.ndarray:
    """Shingles that several texts of a sample have, sorted; at most ``MOST_COMMON``."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    some = docs if share == 1 else docs.sample(share, seed=SEED)
    # copies aren't told apart here: that their shingles come last costs nothing, sorting whole sets would
    items = _sets(some.select(F.col(text).cast("binary").alias("text")), size).select(F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).orderBy(F.desc("n"), "item").limit(MOST_COMMON)
    return np.sort(often.select("item").toArrow()["item"].to_numpy())


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``(fp, items)`` of ``texts(text)``: the whole sets and their names."""

    def one(value: bytes | None) -> tuple:
        found = shingle_set(shingle_hashes(value, size))
        return set_name(found), found

    return texts.mapInArrow(row_map("text", lambda: one, ["fp", "items"], [pa.int64(), pa.list_(pa.int64())]), "fp bigint, items array<bigint>")


def prefixes(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SET_SHINGLE, least: tuple[int, int] = jaccard.LEAST) -> DataFrame:
    """``(doc_id, fp, sim, n, items)`` of every row: name, fingerprint and size of its set, and the set's first items."""
    late = docs.sparkSession.sparkContext.broadcast(common(docs, text, size))
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def make():
        last = late.value

        def one(value: bytes | None) -> tuple:
            hashes = shingle_hashes(value, size)
            found = shingle_set(hashes)
            first = jaccard.ordered(found, last)[: jaccard.prefix_length(len(found), least)]
            return set_name(found), signed(simhash(hashes)), len(found), first

        return one

    run = row_map("text", make, ["fp", "sim", "n", "items"], [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())])
    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp bigint, sim bigint, n bigint, items array<bigint>")


def similar(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SET_SHINGLE, least: tuple[int, int] = jaccard.LEAST, radius: int = 2, direct: int = jaccard.DIRECT) -> DataFrame:
    """``(doc_id, fp, component_id, group)`` for every row of ``docs``: groups of texts whose shingle sets are
    linked by a Jaccard similarity of ``least`` or more; fp names the set."""
    slim = materialise(prefixes(docs, text, key, size, least), "prefixes")
    classes = materialise(slim.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("sim").alias("sim"), F.first("n").alias("n")), "classes")

    def sets(names: DataFrame) -> DataFrame:
        ids = materialise(classes.join(bounded(names), "fp", "left_semi").select("fp", F.col("least").alias("_id")), "ids")
        texts = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
        texts = texts.join(bounded(ids.select("_id").distinct()), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        found = materialise(_sets(texts.select("text"), size).join(bounded(names), "fp", "left_semi"), "sets")
        # more only where rows are repeated, or several texts have one id or none
        return found if found.count() == ids.count() else materialise(found.dropDuplicates(["fp"]), "sets")

    prints = materialise(classes.groupBy("sim").agg(F.min("fp").alias("head")), "prints")
    a, b = (prints.select(F.col("sim").alias(f"sim_{x}"), F.col("head").alias(x)) for x in "ab")
    near = links(prints.select(F.col("sim").alias("fp")), radius).select(F.col("a").alias("sim_a"), F.col("b").alias("sim_b"))
    near = near.join(a, "sim_a").join(b, "sim_b").select("a", "b")
    near = materialise(near.union(classes.join(prints, "sim").where("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))), "near")
    names = materialise(near.select(F.col("a").alias("fp")).union(near.select("b")).distinct(), "wanted")
    linked = materialise(jaccard.compare(near, sets(names), least), "linked")
    parts = materialise(connected_components(linked), "parts")
    known = classes.join(bounded(parts), F.col("fp") == F.col("node"), "left").select("fp", "n", "copies", F.coalesce("component", "fp").alias("part"))
    known = materialise(known, "known")

    copied = materialise(classes.where("copies > 1").select("fp", "least", F.lit(True).alias("copied")), "copied")
    firsts = slim.join(bounded(copied), "fp", "left").where(F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("least")))
    entries = firsts.select("fp", F.posexplode("items").alias("pos", "item"))
    edges = linked.union(jaccard.links(entries, known, sets, least, direct))
    return slim.select("doc_id", "fp").join(grouped(classes.select("fp", "least"), edges), "fp").select("doc_id", "fp", "component_id", "group")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 2, direct: int = 32) -> DataFrame:
    """One row of each group of ``near_duplicates``: one with the group's least id, of several such rows that with
    the least fingerprint and hash."""
    return keep_first(docs, near_duplicates(docs, text, key, radius, direct), lambda t: signed(fingerprint(t)), text, key)


def keep_one_similar(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SET_SHINGLE, least: tuple[int, int] = jaccard.LEAST, radius: int = 2, direct: int = jaccard.DIRECT) -> DataFrame:
    """One row of each group of ``similar``, chosen as in ``keep_one``."""
    return keep_first(docs, similar(docs, text, key, size, least, radius, direct), lambda t: set_name(shingle_set(shingle_hashes(t, size))), text, key)


def keep_first(docs: DataFrame, groups: DataFrame, value: Callable[[bytes | None], int], text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each of ``groups(doc_id, fp, component_id, group)``; ``value`` gives a text's fp. Rows whose id is
    unique are told by it alone; others by id and fp, which is worked out again for them."""
    found = materialise(groups.select("doc_id", "fp", "group", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("first")), "found")
    uses = found.groupBy("doc_id").agg(F.count("*").alias("uses"), F.max("first").alias("first"))
    uses = materialise(uses.select(F.col("doc_id").alias("_id"), "first", ((F.col("uses") == 1) & F.col("doc_id").isNotNull()).alias("alone")), "uses")
    # what goes is few ids as a rule and so broadcast if it is; else ids and rows are joined by sorting
    gone = materialise(uses.where("_id is not null and not (alone and first)").select("_id"), "gone")
    plain = docs.where(docs[key].isNotNull()).join(bounded(gone), docs[key] == gone["_id"], "left_anti")
    others = materialise(uses.where("first and not alone").select("_id"), "others")
    if others.limit(1).count() == 0:
        return plain
    shared = docs.join(bounded(others), docs[key].eqNullSafe(others["_id"]), "left_semi")
    packed = shared.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    run = row_map("text", lambda: lambda t: (value(t),), ["fp"], [pa.int64()])
    marked = packed.mapInArrow(run, packed.drop("text").schema.add("fp", "long"))
    firsts = found.where("first").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "group").distinct()
    one = marked.join(firsts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
    one = one.groupBy("group").agg(F.min_by("row", F.struct("fp", F.xxhash64(F.to_json("row")))).alias("row"))
    return plain.unionByName(one.select("row.*"))
