"""Pairs of sets by Jaccard similarity, exactly: comparison of candidate pairs, and the pairs that other
candidate searches leave out, by prefix filtering.

A set is ``(fp, n, part, copies)`` with its name, size, the group that it is already known to be in, and how often
it occurs. Pairs within one part need no comparison.

*Prefixes.* Two sets of a similarity of t or more share at least t / (1 + t) of their sizes' sum, and t of the
larger's size. In any order of all items, the first n - ceil(t n) + 1 items of the one and of the other have an
item in common, and at the first such item so many items must be left in both as they share at least: no pair is
missed by looking only at pairs whose places pass this bound.

*First round.* Items are ordered by hash, those that are common in a sample put last, so that boilerplate makes
few buckets; what the sample misses costs time and changes no result. Buckets with at most ``direct`` sets are
paired, under the bounds on size and place.

*Second round.* Sets of larger buckets are taken whole and joined again among themselves in the order of exact
counts, rarest first. So what one variant of a text has alone comes first, and the bound on places rules out those
that are too far from the others. Small buckets are paired as before. In a larger bucket every set is compared
with one pivot, the set with the most copies; sets that are linked to it need no comparison with each other,
and the others meet the bucket under the same bounds. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.llm.joins import bounded
from brandbook.session import materialise

#: The least similarity of near-duplicates, as a fraction.
LEAST = (4, 5)
#: Sets that a bucket may have whose pairs are looked at directly.
DIRECT = 64


def prefix_length(n: int, least: tuple[int, int]) -> int:
    """How many first items of a set of ``n`` must meet those of a similar one."""
    return n + least[0] * n // -least[1] + 1 if n else 0


def ordered(found: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The items of a sorted set, those of the sorted ``late`` last."""
    at = np.searchsorted(late, found)
    last = late[np.minimum(at, len(late) - 1)] == found if len(late) else np.zeros(len(found), dtype=bool)
    return np.concatenate([found[~last], found[last]])


def compare(pairs: DataFrame, whole: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs ``(a, b)`` that are similar, of ``pairs(a, b)``, by the sets ``whole(fp, items)``."""
    a, b = (whole.select(F.col("fp").alias(x), F.col("items").alias(f"of_{x}")) for x in "ab")
    both = pairs.distinct().join(a, "a").join(b, "b")
    sizes = both.select("a", "b", (F.size("of_a") + F.size("of_b")).alias("sum"), F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    return sizes.where(F.col("common") * least[1] >= (F.col("sum") - F.col("common")) * least[0]).select("a", "b")


def _may_match(n: Column, pos: Column, part: Column, m: Column, at: Column, of: Column, least: tuple[int, int]) -> Column:
    """Whether two sets of sizes n and m that first meet at places pos and at can be similar, and aren't known to be."""
    num, den = least
    return (part != of) & (F.least(n, m) * den >= F.greatest(n, m) * num) & (F.least(n - pos, m - at) * (num + den) >= (n + m) * num)


def _paired(members: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs of small buckets ``members(item, fp, n, part, pos)``."""
    held = members.groupBy("item").agg(F.collect_list(F.struct("fp", "n", "part", "pos")).alias("held"))
    each = held.select("held", F.explode("held").alias("x"))
    x = lambda f: F.col(f"x.{f}")
    fits = F.filter("held", lambda y: (y["fp"] > x("fp")) & _may_match(x("n"), x("pos"), x("part"), y["n"], y["pos"], y["part"], least))
    return each.select(x("fp").alias("a"), F.explode(F.transform(fits, lambda y: y["fp"])).alias("b"))


def _buckets(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """``entries(item, fp, pos)`` of items that several have, with the bucket's size m and what ``classes`` says."""
    sizes = materialise(entries.groupBy("item").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    return materialise(entries.join(bounded(sizes), "item").join(bounded(classes), "fp"), "shared")


def _by_count(crowd: DataFrame, least: tuple[int, int]) -> DataFrame:
    """``crowd(fp, items)`` to its prefixes ``(fp, pos, item)`` in the order of counts within ``crowd``."""
    items = crowd.select("fp", F.size("items").alias("n"), F.explode("items").alias("item"))
    counts = materialise(items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1"), "counts")
    # items of one set alone come first and meet nothing, so the others' places follow from how many there are
    rest = items.join(bounded(counts), "item").groupBy("fp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("late"))
    alone = F.col("n") - F.size("late")
    length = F.col("n") - F.floor((F.col("n") * least[0] + least[1] - 1) / least[1]) + 1
    prefix = F.slice("late", F.lit(1), F.greatest(F.lit(0), (length - alone).cast("int")))
    return rest.select("fp", alone.alias("alone"), F.posexplode(prefix).alias("i", "x")).select("fp", (F.col("alone") + F.col("i")).alias("pos"), F.col("x.item").alias("item"))


def links(entries: DataFrame, classes: DataFrame, sets: Callable[[DataFrame], DataFrame], least: tuple[int, int] = LEAST, direct: int = DIRECT) -> DataFrame:
    """Edges ``(a, b)`` between similar sets of different parts that, with the parts, connect all similar sets.

    ``entries(item, fp, pos)`` are the sets' prefixes in the first round's order, ``classes(fp, n, part, copies)`` the
    sets, and ``sets(names)`` gives the written table ``(fp, items)`` of whole sets of ``names(fp)``."""
    shared = _buckets(entries, classes)
    pairs = materialise(_paired(shared.where(F.col("m") <= direct), least), "pairs")
    crowd = materialise(shared.where(F.col("m") > direct).select("fp").distinct(), "crowd")
    wanted = crowd.union(pairs.select("a")).union(pairs.select("b")).distinct()
    whole = sets(materialise(wanted, "wanted"))

    again = _buckets(materialise(_by_count(whole.join(bounded(crowd), "fp", "left_semi"), least), "prefixes"), classes)
    pairs = pairs.union(_paired(again.where(F.col("m") <= direct), least))
    large = again.where(F.col("m") > direct)
    pivots = large.groupBy("item").agg(F.max(F.struct("copies", (-F.col("n")).alias("size"), "fp", "n", "part")).alias("pivot"))
    pivots = materialise(pivots.select("item", *(F.col(f"pivot.{c}").alias(f"pivot_{c}") for c in ("fp", "n", "part"))), "pivots")
    headed = materialise(large.drop("m", "copies").join(bounded(pivots), "item"), "headed")
    apart = headed.where(F.col("part") != F.col("pivot_part")).where(F.least("n", "pivot_n") * least[1] >= F.greatest("n", "pivot_n") * least[0])
    stars = materialise(compare(apart.select(F.col("pivot_fp").alias("a"), F.col("fp").alias("b")), whole, least), "stars")

    near = bounded(stars.select(F.col("a").alias("pivot_fp"), F.col("b").alias("fp"), F.lit(True).alias("near")))
    placed = headed.where(F.col("fp") != F.col("pivot_fp")).join(near, ["pivot_fp", "fp"], "left")
    placed = placed.withColumn("near", (F.col("part") == F.col("pivot_part")) | F.coalesce("near", F.lit(False)))
    placed = materialise(placed.select("item", "fp", "n", "part", "pos", "near"), "placed")
    x, y = (placed.select(*(F.col(c).alias(f"{side}_{c}") for c in placed.columns)) for side in "xy")
    x_, y_ = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    fits = _may_match(x_("n"), x_("pos"), x_("part"), y_("n"), y_("pos"), y_("part"), least)
    met = x.where("not x_near").join(y, (x_("item") == y_("item")) & (y_("near") | (x_("fp") < y_("fp"))) & fits)
    pairs = pairs.union(met.select(F.least("x_fp", "y_fp").alias("a"), F.greatest("x_fp", "y_fp").alias("b")))
    return stars.union(compare(pairs, whole, least))
