"""Queries and maintenance over the graph's tables. Tables are frames in a dict, as ``resolve.replay`` gives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brandbook.functions import norm
from brandbook.operators.components import connected_components
from brandbook.schema import UNIQUE
from brandbook.session import materialise

MOST_GENERATIONS = 20


def pedigree(lines: DataFrame, roots: DataFrame, generations: int = 5) -> DataFrame:
    """(root, uid, depth, role, path): one row per path upwards, so an inbred ancestor comes once per way.

    ``lines(child_uid, parent_uid, role)``, ``roots(uid)``. Generations are held to 1..20; one join each, which
    shares the exchange of ``lines`` and ends at once where a level is empty."""
    generations = max(1, min(MOST_GENERATIONS, generations))
    level = roots.select(F.col("uid").alias("root"), F.col("uid").alias("at"), F.array("uid").alias("path"))
    levels = []
    for depth in range(1, generations + 1):
        up = level.join(lines, level.at == lines.child_uid).select("root", F.col("parent_uid").alias("at"), F.lit(depth).alias("depth"), "role", F.array_append("path", F.col("parent_uid")).alias("path"))
        if depth % 4 == 0:
            up = materialise(up, "generation")
        levels.append(up)
        level = up.select("root", "at", "path")
    return reduce(DataFrame.unionAll, levels).select("root", F.col("at").alias("uid"), "depth", "role", "path")


def pedigree_of(spark: SparkSession, lines: DataFrame, uid: str, generations: int = 5) -> DataFrame:
    """The same for one animal, as a recursive query."""
    generations = max(1, min(MOST_GENERATIONS, generations))
    return spark.sql(
        """
        WITH RECURSIVE up(uid, depth, role, path) MAX RECURSION LEVEL 25 AS (
          SELECT parent_uid, 1, role, array(child_uid, parent_uid) FROM {lines} WHERE child_uid = :uid
          UNION ALL
          SELECT l.parent_uid, depth + 1, l.role, array_append(path, l.parent_uid) FROM up JOIN {lines} l ON l.child_uid = up.uid WHERE depth < :generations)
        SELECT :uid AS root, uid, depth, role, path FROM up
        """,
        {"uid": uid, "generations": generations},
        lines=lines,
    )


def ancestors(lines: DataFrame, roots: DataFrame, generations: int = 4) -> DataFrame:
    """(root, uid, depth): each distinct ancestor once, at its least depth; a level only keeps what is new."""
    seen = roots.select(F.col("uid").alias("root"), "uid", F.lit(0).alias("depth"))
    front = seen
    for depth in range(1, generations + 1):
        up = front.join(lines, front.uid == lines.child_uid).select("root", F.col("parent_uid").alias("uid")).distinct()
        front = materialise(up.join(seen, ["root", "uid"], "left_anti").withColumn("depth", F.lit(depth)), "front")
        seen = seen.unionByName(front)
    return seen


def subgraph(lines: DataFrame, roots: DataFrame, generations: int = 4) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges about each root: ancestors of some generations, and the root's own young."""
    up = ancestors(lines, roots, generations)
    kids = lines.join(roots, lines.parent_uid == roots.uid, "left_semi").select(F.col("parent_uid").alias("root"), F.col("child_uid").alias("uid"))
    nodes = materialise(up.select("root", "uid").unionByName(kids).distinct(), "nodes")
    inner = nodes.select("root", F.col("uid").alias("child_uid"))
    edges = lines.join(inner, "child_uid").join(nodes.select("root", F.col("uid").alias("parent_uid")), ["root", "parent_uid"])
    return nodes, edges.select("root", "child_uid", "parent_uid", "role").distinct()


def real_registrations(registrations: DataFrame, animals: DataFrame) -> DataFrame:
    """Registrations of crawled animals: neither stubs nor steers'."""
    steers = animals.where(norm.key(F.col("sex")) == "S").select("uid")
    return registrations.where(~F.coalesce("stub", F.lit(False))).join(steers, "uid", "left_anti")


def per_association(registrations: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """(association, n); with ``codes(association)`` those without any are there with 0."""
    counts = registrations.groupBy("association").agg(F.count("*").alias("n"))
    if codes is None:
        return counts
    return codes.join(counts, "association", "left").select("association", F.coalesce("n", F.lit(0)).alias("n"))


def multi_association(registrations: DataFrame) -> DataFrame:
    """(uid, associations) of animals in more than one registry."""
    return registrations.groupBy("uid").agg(F.array_sort(F.collect_set("association")).alias("associations")).where(F.size("associations") > 1)


def duplicate_groups(animals: DataFrame, keys: list[str], where: Column | None = None, uid: str = "uid") -> DataFrame:
    """Groups of equal keys: the keys, copies, and sorted uids. For the dashboards' count use the loader's or no
    filter, for the reconcile preview ``norm.is_reconcilable``."""
    rows = animals if where is None else animals.where(where)
    return rows.groupBy(*keys).agg(F.count("*").alias("copies"), F.array_sort(F.collect_list(uid)).alias("uids")).where("copies > 1")


def defect_distribution(defects: DataFrame) -> DataFrame:
    return defects.groupBy(F.coalesce("status", F.lit("Unknown")).alias("status")).agg(F.count("*").alias("n"))


def carriers(animals: DataFrame, defects: DataFrame, code: str, limit: int | None = 200) -> DataFrame:
    """Animals that carry a defect, by name (nulls last)."""
    found = animals.join(defects.where((F.col("code") == code) & (F.col("status") == "Carrier")).select("uid"), "uid", "left_semi").orderBy(F.asc_nulls_last("name"), "uid")
    return found if limit is None else found.limit(limit)


def by_breed(animals: DataFrame, breeds: DataFrame, breed: str, at_least: float = 0.0, limit: int | None = 200) -> DataFrame:
    """Animals with a share of a breed, greatest share first (null shares first, null names last)."""
    found = animals.join(breeds.where((F.col("breed") == breed) & (F.col("percent") >= at_least)), "uid").orderBy(F.desc_nulls_first("percent"), F.asc_nulls_last("name"), "uid")
    return found if limit is None else found.limit(limit)


def breed_totals(breeds: DataFrame) -> DataFrame:
    """(uid, total): about 100 where the composition is whole."""
    return breeds.groupBy("uid").agg(F.round(F.sum("percent"), 3).alias("total"))


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Each animal with its registrations, breeds, defects, cases and parents as arrays. Every side is
    aggregated by uid before it is joined, so rows don't multiply. Stub registrations aren't shown."""
    regs = tables["registration"].where(~F.coalesce("stub", F.lit(False)))
    lists = [
        regs.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("association", "regNumber", "breeder", "owner", "epds", "attributes"))).alias("registrations")),
        tables["animal_breed"].groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("breed", "percent"))).alias("breeds")),
        tables["animal_defect"].groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("code", "status"))).alias("defects")),
        tables["animal_dna"].groupBy("uid").agg(F.array_sort(F.collect_set("case_id")).alias("cases")),
    ]
    names = tables["animal"].select(F.col("uid").alias("parent_uid"), F.col("name").alias("parent_name"))
    parents = tables["parentage"].join(names, "parent_uid", "left").groupBy(F.col("child_uid").alias("uid"))
    lists.append(parents.agg(F.array_sort(F.collect_set(F.struct("role", "parent_uid", "parent_name"))).alias("parents")))
    out = tables["animal"]
    for one in lists:
        out = out.join(one, "uid", "left")
    return out


def find(animals: DataFrame, registrations: DataFrame, text: str) -> DataFrame:
    """The animal that a search means: its uid, part of its name, or a registration number; one row at most."""
    wanted = F.lit(text)
    hits = [
        animals.where(F.col("uid") == wanted).select("uid", "name", F.lit(0).alias("way")),
        animals.where(F.lower("name").contains(F.lower(wanted))).select("uid", "name", F.lit(1).alias("way")),
        animals.join(registrations.where(F.upper("regNumber") == F.upper(wanted)), "uid", "left_semi").select("uid", "name", F.lit(2).alias("way")),
    ]
    return reduce(DataFrame.unionAll, hits).orderBy("way", F.asc_nulls_last("name"), "uid").limit(1).drop("way")


def renamed(tables: dict[str, DataFrame], mapping: DataFrame) -> dict[str, DataFrame]:
    """All tables after animals were merged by ``mapping(uid, keep)``: gaps of the kept animal are filled from
    the others in order of uid, references follow, repeated edges fall, and lines from a dropped animal to
    itself fall."""
    m = materialise(mapping.where("uid <> keep").select(F.col("uid").alias("old"), "keep"), "mapping")

    def follow(df: DataFrame, column: str) -> DataFrame:
        return df.join(m, F.col(column) == F.col("old"), "left").withColumn(column, F.coalesce("keep", column)).drop("old", "keep")

    out = dict(tables)
    animals = tables["animal"].join(m, F.col("uid") == F.col("old"), "left").withColumn("home", F.coalesce("keep", "uid"))
    order = F.struct((F.col("uid") != F.col("home")).alias("merged"), F.col("uid"))
    values = [c for c in tables["animal"].columns if c != "uid"]
    filled = animals.groupBy("home").agg(*(F.min_by(F.col(c), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), order)).alias(c) for c in values))
    out["animal"] = filled.withColumnRenamed("home", "uid").select(*tables["animal"].columns)
    for name in ("registration", "animal_dna", "animal_breed"):
        out[name] = follow(tables[name], "uid").distinct()
    moved = tables["animal_defect"].join(m, F.col("uid") == F.col("old"), "left").withColumn("home", F.coalesce("keep", "uid"))
    out["animal_defect"] = moved.groupBy(F.col("home").alias("_uid"), "code").agg(F.max_by("status", F.struct(F.col("old").isNotNull(), F.col("uid"))).alias("status")).select(F.col("_uid").alias("uid"), "code", "status")
    itself = tables["parentage"].join(m, (F.col("child_uid") == F.col("parent_uid")) & (F.col("child_uid") == F.col("old")), "left_anti")
    out["parentage"] = follow(follow(itself, "child_uid"), "parent_uid").distinct()
    return out


def reconcile(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Merge all animals of one reconcilable name and birth date into the first of them."""
    rows = tables["animal"].where(norm.is_reconcilable(F.col("name_norm"), F.col("dob")))
    keep = rows.groupBy("name_norm", "dob").agg(F.min("uid").alias("keep"), F.count("*").alias("n")).where("n > 1")
    return renamed(tables, rows.join(keep, ["name_norm", "dob"]).select("uid", "keep"))


def merged_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs(a, b)`` of equal animals to ``mapping(uid, keep)``."""
    return connected_components(pairs).select(F.col("node").alias("uid"), F.col("component").alias("keep"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; a value of ``new`` replaces the old one unless it is null."""
    a, b = old.alias("a"), new.alias("b")
    on = reduce(lambda x, y: x & y, (F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys))
    pick = [F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in new.columns else F.col(f"a.{c}").alias(c) for c in old.columns]
    return a.join(b, on, "full").select(*pick)


def without_steers(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Steers and all that hangs on them are gone."""
    steers = materialise(tables["animal"].where(norm.key(F.col("sex")) == "S").select(F.col("uid").alias("gone")), "steers")
    out = dict(tables)
    for name in ("animal", "registration", "animal_dna", "animal_breed", "animal_defect"):
        out[name] = tables[name].join(steers, F.col("uid") == F.col("gone"), "left_anti")
    for end in ("child_uid", "parent_uid"):
        out["parentage"] = out["parentage"].join(steers, F.col(end) == F.col("gone"), "left_anti")
    return out


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, key, n) where a key that must be unique isn't."""
    found = [tables[t].groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(t).alias("table"), F.concat_ws(":", *keys).alias("key"), "n") for t, keys in UNIQUE.items() if t in tables]
    return reduce(DataFrame.unionAll, found)


def cardinalities(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) of a load."""
    return reduce(DataFrame.unionAll, (df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t, df in tables.items()))


def duplicate_preview(animals: DataFrame, most: int = 50) -> DataFrame:
    """What a reconcile would merge: the largest groups first, ``most`` of them."""
    found = duplicate_groups(animals, ["name_norm", "dob"], norm.is_reconcilable(F.col("name_norm"), F.col("dob")))
    return found.orderBy(F.desc("copies"), "name_norm", "dob").limit(most)


def kids_shown(lines: DataFrame, most: int = 60) -> DataFrame:
    """(root, uid): the first ``most`` young of every animal by uid, each once."""
    kids = lines.select(F.col("parent_uid").alias("root"), F.col("child_uid").alias("uid")).distinct()
    place = F.row_number().over(Window.partitionBy("root").orderBy("uid"))
    return kids.withColumn("_n", place).where(F.col("_n") <= most).drop("_n")


def view(nodes: DataFrame, most_nodes: int = 200) -> DataFrame:
    """What a drawing shows of each root's nodes: the first by uid, the root itself always."""
    own = (F.col("uid") != F.col("root")).alias("other")
    kept = nodes.groupBy("root").agg(F.slice(F.array_sort(F.collect_set(F.struct(own, F.col("uid")))), 1, most_nodes).alias("shown"))
    return kept.select("root", F.explode("shown").alias("x")).select("root", "x.uid")
