"""Entity resolution: which records and parent references are one animal.

``replay`` gives exactly what reading the records one by one gives: a ladder of keys, strongest first, over
the state that earlier records left. Mentions are first put into blocks that cannot touch each other, so blocks
are replayed apart, in parallel, each in order of ``seq``. Blocks start as connected components over the keys that
identify by themselves (international id, registration, case, cross reference). An animal's other values may come
from any mention of its block, so blocks are then joined where they share a tattoo with birth date and sex, or a name
with birth date, in any combination, and where a name that identifies by itself is also on a mention without birth
date; that is repeated until nothing joins. ``closure`` is the set-based variant: components over the ladder's keys
as they are in the records, whatever their order.

A block is read as a sorted stream: what is held is its animals and their keys, not its mentions, so a sire that a
third of all records name is one animal and a stream of references. No block is refused or cut; its mentions are
read by one task, since each depends on those before it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.functions import norm
from brandbook.operators.components import connected_components
from brandbook.schema import TABLES
from brandbook.session import materialise

FIELDS = ("intl_id", "name", "name_norm", "sex", "dob", "tattoo", "color", "horn_status")
OUTPUT = "kind string, block bigint, payload string"
OUT_ROWS = 5_000
#: Combinations of values up to which a block lists them; wider blocks are tested value by value.
LISTED = 256


def prepared(records: DataFrame, skip_steers: bool = False, preserve_affected: bool = False) -> DataFrame:
    """Records with normalised keys; ``seq`` is their order. Steers are left out before anything else."""
    blank = lambda c: F.nullif(c, F.lit(""))
    trimmed = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = records.where(norm.key(F.col("sex")) != "S") if skip_steers else records

    def parent(role: str) -> Column:
        p = F.col(role)
        n = norm.name(p["name"])
        has_reg = F.coalesce(p["regNumber"], F.lit("")) != ""
        return F.when(
            p.isNotNull(),
            F.struct(norm.key(p["intl_id"]).alias("intl"), F.when(has_reg, norm.key(p["association"])).alias("assoc"), F.when(has_reg, norm.key(p["regNumber"])).alias("reg"), p["name"].alias("name"), n.alias("norm"), norm.is_specific(n).alias("specific")),
        )

    empty = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    cases = F.filter(F.transform(empty("dna_cases", "array<string>"), lambda x: norm.key(x)), lambda x: x != "")
    xrefs = F.transform(empty("cross_refs", "array<struct<association:string,regNumber:string>>"), lambda x: F.struct(norm.key(x["association"]).alias("assoc"), norm.key(x["regNumber"]).alias("reg")))
    breeds = F.filter(
        F.transform(empty("breed_composition", "array<struct<breed:string,percent:double>>"), lambda x: F.struct(norm.key(x["breed"]).alias("breed"), F.coalesce(x["percent"], F.lit(0.0)).alias("percent"))), lambda x: x["breed"] != ""
    )
    defects = F.filter(
        F.transform(empty("defects", "array<struct<code:string,status:string>>"), lambda x: F.struct(norm.key(x["code"]).alias("code"), norm.defect_status(x["status"], preserve_affected).alias("status"))), lambda x: x["code"] != ""
    )
    return rows.select(
        "seq", norm.key(F.col("association")).alias("assoc"), norm.key(F.col("regNumber")).alias("reg"), F.col("name"), norm.name(F.col("name")).alias("norm"),
        norm.is_generic(norm.name(F.col("name"))).alias("generic"), norm.is_specific(norm.name(F.col("name"))).alias("specific"), norm.key(F.col("intl_id")).alias("intl"), blank(norm.key(F.col("sex"))).alias("sex"), blank(trimmed("dob")).alias("dob"),
        blank(norm.key(F.col("tattoo"))).alias("tattoo"), blank(trimmed("color")).alias("color"), norm.horn(F.col("horn_status")).alias("horn"), cases.alias("cases"), xrefs.alias("xrefs"), breeds.alias("breeds"), defects.alias("defects"),
        parent("sire").alias("sire"), parent("dam").alias("dam"), "breeder", "owner", F.to_json("epds").alias("epds"), "attributes", "source_url", "scraped_at",
    )


def block_keys(rows: DataFrame) -> DataFrame:
    """(mention, key): the keys that identify by themselves. A mention is three times ``seq`` plus 0 for the
    record, 1 for its sire, 2 for its dam."""
    own = [F.when(F.col("intl") != "", F.concat(F.lit("I:"), F.col("intl"))), F.concat_ws(":", F.lit("R"), "assoc", "reg")]
    lists = F.concat(F.array(*own), F.transform("cases", lambda c: F.concat(F.lit("D:"), c)), F.transform("xrefs", lambda x: F.concat_ws(":", F.lit("R"), x["assoc"], x["reg"])))

    def parent(role: str) -> Column:
        p = F.col(role)
        return F.array(F.when(p["intl"] != "", F.concat(F.lit("I:"), p["intl"])), F.when(p["reg"].isNotNull(), F.concat_ws(":", F.lit("R"), p["assoc"], p["reg"])))

    mentions = F.array(*(F.struct(F.lit(i).alias("i"), keys.alias("keys")) for i, keys in enumerate((lists, parent("sire"), parent("dam")))))
    exploded = rows.select("seq", F.explode(mentions).alias("m")).select((3 * F.col("seq") + F.col("m.i")).alias("mention"), F.explode("m.keys").alias("key"))
    return exploded.where("key is not null").distinct()


def facts(rows: DataFrame) -> DataFrame:
    """(mention, tattoo, dob, sex, name, specific, dated) of every mention; a generic name is no name."""
    own = rows.select((3 * F.col("seq")).alias("mention"), "tattoo", "dob", "sex", F.when(~F.col("generic"), F.col("norm")).alias("name"), F.col("specific") & ~F.col("generic"), F.col("dob").isNotNull().alias("dated"))
    none = F.lit(None).cast("string")

    def parent(i: int, role: str) -> DataFrame:
        p = F.col(role)
        name = F.when((p["norm"] != "") & ~norm.is_generic(p["norm"]), p["norm"])
        return rows.where(p.isNotNull()).select((3 * F.col("seq") + i).alias("mention"), none, none, none, name.alias("name"), p["specific"], F.lit(False))

    return own.union(parent(1, "sire")).union(parent(2, "dam")).toDF("mention", "tattoo", "dob", "sex", "name", "specific", "dated")


def linked(keys: DataFrame, node: str) -> DataFrame:
    """Edges (a, b) from ``keys(node, key)``: a key links its nodes to the least of them."""
    least = materialise(keys.groupBy("key").agg(F.min(node).alias("least"), F.max(node).alias("most")).where("least <> most"), "least")
    return keys.join(least, "key").select(F.col(node).alias("a"), F.col("least").alias("b")).where("a <> b")


def blocks(keys: DataFrame) -> DataFrame:
    """(mention, block) for every mention of ``keys(mention, key)``, the least mention of each component."""
    keys = materialise(keys, "keys")
    found = connected_components(linked(keys, "mention"))
    return keys.select("mention").distinct().join(found, F.col("mention") == F.col("node"), "left").select("mention", F.coalesce("component", "mention").alias("block"))


def weak_links(placed: DataFrame, listed: int = LISTED) -> DataFrame:
    """Edges (a, b) that may join blocks of ``placed(block, ...facts)``; values of several mentions combine, and only
    values that several blocks have are looked at.

    A block lists its combinations as keys if they are few. A junk key may gather thousands of names and dates in one
    block, whose product nothing should list: such wide blocks are met by the combinations that others list, through one
    of the values and then a test of the rest, and by each other in pairs of wide blocks that share each kind of value."""
    pairs = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("name", "tattoo", "dob", "sex")))
    values = placed.select("block", F.explode(pairs).alias("x")).where("x.value is not null").select("block", "x.kind", "x.value").distinct()
    values = materialise(values, "values")

    def own(c: str) -> DataFrame:
        rows = values.where(F.col("kind") == c).select("block", F.col("value").alias(c))
        return rows if c in ("dob", "sex") else rows.join(rows.groupBy(c).agg(F.count("*").alias("n")).where("n > 1").select(c), c).select("block", c)

    sizes = {}
    for kinds in (("tattoo", "dob", "sex"), ("name", "dob")):
        counts = own(kinds[0]).groupBy("block").agg(F.count("*").cast("double").alias("size"))
        for c in kinds[1:]:
            more = own(c).groupBy("block").agg(F.count("*").cast("double").alias("n"))
            counts = counts.join(more, "block").select("block", (F.col("size") * F.col("n")).alias("size"))
        sizes[kinds] = counts.select("block", (F.col("size") > listed).alias("wide"), F.lit(kinds[0]).alias("kind"))
    sized = materialise(reduce(DataFrame.union, sizes.values()), "sized")
    wide_kinds = {r.kind for r in sized.where("wide").select("kind").distinct().collect()}

    loose = placed.where("name is not null and specific and not dated").select("name").distinct()
    keys = own("name").join(loose, "name", "left_semi").select("block", F.concat(F.lit("N|"), "name").alias("key"))
    edges = []
    for kinds in sizes:
        combined = own(kinds[0]).join(sized.where((F.col("kind") == kinds[0]) & ~F.col("wide")).select("block"), "block")
        for c in kinds[1:]:
            combined = combined.join(own(c), "block")
        if kinds[0] in wide_kinds:
            combined = materialise(combined, "combined")
            wide = sized.where((F.col("kind") == kinds[0]) & F.col("wide")).select("block")
            edges += _wide_links(combined, {c: materialise(own(c).join(wide, "block"), "wide") for c in kinds})
        keys = keys.union(combined.select("block", F.concat_ws("|", F.lit(kinds[0]), *kinds).alias("key")))
    return reduce(DataFrame.union, edges, linked(keys, "block")).distinct()


def _wide_links(combined: DataFrame, wide: dict[str, DataFrame]) -> list[DataFrame]:
    """Edges of wide blocks to the least block of each combination that others list, and to each other."""
    first, *rest = wide
    met = combined.groupBy(*wide).agg(F.min("block").alias("b")).join(wide[first].withColumnRenamed("block", "a"), first)
    pairs = wide[first].withColumnRenamed("block", "a").join(wide[first].withColumnRenamed("block", "b"), first).where("a < b").select("a", "b").distinct()
    for c in rest:
        met = met.join(wide[c].withColumnRenamed("block", "a"), ["a", c], "left_semi")
        both = pairs.join(wide[c].withColumnRenamed("block", "a"), "a").join(wide[c].withColumnRenamed("block", "b"), ["b", c])
        pairs = both.select("a", "b").distinct()
    return [met.select("a", "b"), pairs]


def mention_blocks(rows: DataFrame) -> DataFrame:
    """(mention, block) of all mentions of ``prepared`` rows that any rung may resolve."""
    known = materialise(facts(rows), "facts")
    home = materialise(blocks(block_keys(rows).union(known.select("mention", F.concat(F.lit("M:"), F.col("mention").cast("string"))))), "blocks")
    while True:
        placed = materialise(known.join(home, "mention").select("block", "tattoo", "dob", "sex", "name", "specific", "dated").distinct(), "placed")
        joined = materialise(connected_components(weak_links(placed)), "joined")
        if joined.limit(1).count() == 0:
            return home
        home = materialise(home.join(joined, F.col("block") == F.col("node"), "left").select("mention", F.coalesce("component", "block").alias("block")), "blocks")


class _Herd:
    """The animals of one block while its mentions are replayed; ``out`` takes rows that are settled."""

    def __init__(self, out: list[tuple[str, dict]]):
        self.out = out
        self.animals: dict[str, dict] = {}
        self.index: dict[str, dict] = {"intl": {}, "reg": {}, "case": {}}
        #: keys of each index by animal
        self.keys: dict[tuple[str, str], set] = {}
        self.papers: dict[tuple, dict] = {}
        self.breeds: dict[str, set[tuple]] = {}
        #: by animal and code: when the pair first came, and the status
        self.defects: dict[str, dict[str, tuple[int, str]]] = {}
        #: parent mention -> [child, parent] while both are of this block and the line stands, and mentions by animal
        self.lines: dict[int, list[str]] = {}
        self.lines_of: dict[str, set[int]] = {}
        self.renamed: dict[str, str] = {}
        #: animals by what they are found by, the order in which they came, and dated animals of a name as a heap
        self.marked: dict[tuple, set[str]] = {}
        self.rank: dict[str, int] = {}
        self.dated: dict[str, list[tuple[int, str]]] = {}
        self.clock = 0

    def tick(self) -> int:
        self.clock += 1
        return self.clock

    def log(self, mention: int, uid: str, rung: str) -> None:
        self.out.append(("log", {"mention": mention, "step": self.tick(), "uid": uid, "rung": rung}))

    def _marks(self, uid: str) -> Iterator[tuple]:
        a = self.animals[uid]
        name, dob, tattoo, sex = (a.get(f) for f in ("name_norm", "dob", "tattoo", "sex"))
        if tattoo and dob and sex:
            yield "tattoo", tattoo, dob, sex
        if name and dob:
            yield "name", name, dob
        if name and not dob:
            yield "stub", name

    def _mark(self, uid: str) -> None:
        for mark in self._marks(uid):
            found = self.marked.setdefault(mark, set())
            if uid not in found:
                found.add(uid)
                if mark[0] == "name":
                    heapq.heappush(self.dated.setdefault(mark[1], []), (self.rank[uid], uid))

    def _unmark(self, uid: str) -> None:
        for mark in self._marks(uid):
            self.marked.get(mark, set()).discard(uid)

    def like(self, *mark) -> list[str]:
        """Animals with a mark, the earliest first."""
        return sorted(self.marked.get(mark, ()), key=self.rank.get)

    def first_dated(self, name: str) -> str | None:
        """The earliest animal of a name that has a birth date."""
        heap = self.dated.get(name, [])
        while heap and (heap[0][1] not in self.animals or self.rank[heap[0][1]] != heap[0][0]):
            heapq.heappop(heap)
        return heap[0][1] if heap else None

    def own(self, index: str, key, uid: str) -> None:
        if (old := self.index[index].get(key)) is not None:
            self.keys[index, old].discard(key)
        self.index[index][key] = uid
        self.keys.setdefault((index, uid), set()).add(key)

    def add(self, uid: str, values: dict) -> None:
        if uid in self.animals:
            self._unmark(uid)
        else:
            self.rank[uid] = self.tick()
        self.animals[uid] = dict(values)
        self._mark(uid)
        if values.get("intl_id"):
            self.own("intl", values["intl_id"], uid)

    def fill(self, uid: str, values: dict) -> None:
        known = self.animals[uid]
        more = {k: v for k, v in values.items() if v and not known.get(k)}
        if more:
            self._unmark(uid)
            known.update(more)
            self._mark(uid)

    def paper(self, uid: str, key: tuple, values: dict) -> None:
        self.papers.setdefault(key, {}).update(values)
        self.own("reg", key, uid)

    def defect(self, uid: str, code: str, status: str) -> None:
        own = self.defects.setdefault(uid, {})
        own[code] = (own[code][0] if code in own else self.tick(), status)

    def line(self, mention: int, child: str, parent: str) -> None:
        self.lines[mention] = [child, parent]
        for uid in {child, parent}:
            self.lines_of.setdefault(uid, set()).add(mention)

    def merge(self, keep: str, drop: str) -> None:
        """Everything of ``drop`` goes to ``keep``, in the time that ``drop``'s own things take."""
        self._unmark(drop)
        self.fill(keep, self.animals.pop(drop))
        for name, index in self.index.items():
            moved = self.keys.pop((name, drop), set())
            index.update(dict.fromkeys(moved, keep))
            self.keys.setdefault((name, keep), set()).update(moved)
        self.breeds.setdefault(keep, set()).update(self.breeds.pop(drop, ()))
        own = self.defects.setdefault(keep, {})
        for code, (at, status) in self.defects.pop(drop, {}).items():
            # of two the later one counts, at the place of the earlier
            before = own.get(code, (at, status))
            own[code] = min(at, before[0]), status if at > before[0] else before[1]
        for mention in self.lines_of.pop(drop, ()):
            child, parent = self.lines[mention]
            if child == parent == drop:
                # a line from the dropped animal to itself falls; one that only now joins an animal to itself stays
                del self.lines[mention]
                self.out.append(("fallen", {"mention": mention}))
            else:
                self.lines[mention] = [keep if x == drop else x for x in (child, parent)]
                self.lines_of.setdefault(keep, set()).add(mention)
        self.renamed[drop] = keep

    def current(self, uid: str) -> str:
        while uid not in self.animals and uid in self.renamed:
            uid = self.renamed[uid]
        return uid


def _values(r) -> dict:
    return {"intl_id": r["intl"] or None, "name": r["name"], "name_norm": r["norm"], "sex": r["sex"], "dob": r["dob"], "tattoo": r["tattoo"], "color": r["color"], "horn_status": r["horn"]}


def _climb(herd: _Herd, r: dict) -> tuple[str | None, str]:
    """The animal that a record is by the ladder, and the rung that says so."""
    intl, reg, case = (herd.index[k].get for k in ("intl", "reg", "case"))
    if r["intl"] and (uid := intl(r["intl"])):
        return uid, "intl_id"
    if uid := reg((r["assoc"], r["reg"])):
        return uid, "registration"
    for one in r["cases"]:
        if uid := case(one):
            return uid, "dna"
    for x in r["xrefs"]:
        if uid := reg((x["assoc"], x["reg"])):
            return uid, "cross_ref"
    if r["tattoo"] and r["dob"] and r["sex"] and (found := herd.like("tattoo", r["tattoo"], r["dob"], r["sex"])):
        return found[0], "tattoo_dob_sex"
    if r["norm"] and r["dob"] and not r["generic"] and (found := herd.like("name", r["norm"], r["dob"])):
        return found[0], "name_dob"
    return None, "created"


def _replay_record(herd: _Herd, r: dict) -> str:
    uid, rung = _climb(herd, r)
    values = _values(r)
    if uid is None:
        uid = f"{r['assoc']}:{r['reg']}"
        herd.add(uid, values)
    else:
        herd.fill(uid, values)
        if values["intl_id"] and values["intl_id"] not in herd.index["intl"]:
            herd.own("intl", values["intl_id"], uid)
    herd.log(3 * r["seq"], uid, rung)
    named = r["norm"] and r["dob"] and not r["generic"]
    for marks in ([("name", r["norm"], r["dob"])] if named else []) + ([("stub", r["norm"])] if r["dob"] and r["specific"] else []):
        for other in herd.like(*marks):
            if other != uid:
                herd.merge(uid, other)
                herd.log(3 * r["seq"], uid, "name_dob")
    herd.paper(uid, (r["assoc"], r["reg"]), {"name_as_recorded": r["name"], **{k: r[k] for k in ("breeder", "owner", "epds", "attributes", "source_url", "scraped_at")}, "stub": False})
    for case in r["cases"]:
        herd.own("case", case, uid)
    herd.breeds.setdefault(uid, set()).update((b["breed"], b["percent"]) for b in r["breeds"])
    for d in r["defects"]:
        herd.defect(uid, d["code"], d["status"])
    for x in r["xrefs"]:
        if (x["assoc"], x["reg"]) not in herd.index["reg"]:
            herd.paper(uid, (x["assoc"], x["reg"]), {"stub": True, "via_cross_ref": True})
    return uid


def _replay_parent(herd: _Herd, mention: int, p: dict) -> str | None:
    key = (p["assoc"], p["reg"]) if p["reg"] else None
    uid = (herd.index["intl"].get(p["intl"]) if p["intl"] else None) or (herd.index["reg"].get(key) if key else None)
    if uid:
        return uid
    if not key and not p["intl"]:
        return None
    if p["specific"] and (found := herd.first_dated(p["norm"])):
        if key:
            herd.paper(found, key, {"stub": True})
        return found
    uid = ":".join(key) if key else p["intl"]
    herd.add(uid, {"intl_id": p["intl"] or None, "name": p["name"], "name_norm": p["norm"]})
    if key:
        herd.paper(uid, key, {"stub": True})
    herd.log(mention, uid, "created")
    return uid


class _Replay:
    """One block: mentions go in by ``take`` in order, rows of the tables come out of ``out``. Mentions come out as
    they were resolved at their time; ``finish`` tells what those animals are called in the end. Lines of descent come
    out per mention, since a parent may be of another block."""

    def __init__(self):
        self.out: list[tuple[str, dict]] = []
        self.herd = _Herd(self.out)
        self.child: tuple[int, str] | None = None

    def take(self, mention: int, body: dict) -> None:
        seq, role = divmod(mention, 3)
        uid = _replay_record(self.herd, body) if role == 0 else _replay_parent(self.herd, mention, body)
        if not uid:
            return
        self.out.append(("mention", {"mention": mention, "uid": uid}))
        if role == 0:
            self.child = seq, uid
        elif self.child and self.child[0] == seq:
            self.herd.line(mention, self.herd.current(self.child[1]), uid)

    def finish(self) -> list[tuple[str, dict]]:
        herd, out = self.herd, self.out
        for uid, a in herd.animals.items():
            out.append(("animal", {"uid": uid, **{f: a.get(f) for f in FIELDS}}))
        for (assoc, reg), v in herd.papers.items():
            out.append(("registration", {"association": assoc, "regNumber": reg, "uid": herd.index["reg"][assoc, reg], **v}))
        out += [("animal_dna", {"case_id": case, "uid": uid}) for case, uid in herd.index["case"].items()]
        out += [("animal_breed", {"uid": uid, "breed": breed, "percent": percent}) for uid, breeds in herd.breeds.items() for breed, percent in breeds]
        out += [("animal_defect", {"uid": uid, "code": code, "status": status}) for uid, codes in herd.defects.items() for code, (_, status) in codes.items()]
        out += [("renamed", {"old": old, "uid": herd.current(old)}) for old in herd.renamed]
        return out


def _replay_sorted(batches):
    """Replays blocks one after another from rows sorted by block and mention; of a task's rows only the animals of
    one block and the results not yet handed on are held. Blocks are small, and share the batches that are handed on."""
    block, replay, told = None, _Replay(), []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "mention", "body"))
        for at, mention, body in zip(*columns, strict=True):
            if at != block:
                yield from _handed(told, block, replay.finish())
                block, replay = at, _Replay()
            replay.take(mention, json.loads(body))
            if len(replay.out) >= OUT_ROWS:
                yield from _handed(told, block, replay.out)
                replay.out.clear()
    yield from _handed(told, block, replay.finish())
    if told:
        yield _batch(told)


def _handed(told: list[tuple[str, int, str]], block: int | None, rows: list[tuple[str, dict]]) -> Iterator[pa.RecordBatch]:
    """Adds a block's rows to those ``told``, and hands these on whenever they are enough for a batch."""
    for at in range(0, len(rows), OUT_ROWS):
        told += [(kind, block, json.dumps(row)) for kind, row in rows[at : at + OUT_ROWS]]
        if len(told) >= OUT_ROWS:
            yield _batch(told)
            told.clear()


def _batch(told: list[tuple[str, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*told), (pa.string(), pa.int64(), pa.string()), strict=True)], names=["kind", "block", "payload"])


def mentions_of(rows: DataFrame) -> DataFrame:
    """(mention, body) of ``prepared`` rows."""
    own = F.to_json(F.struct(*(c for c in rows.columns if c not in ("sire", "dam"))), {"ignoreNullFields": "false"})
    bodies = F.array(F.struct(F.lit(0).alias("i"), own.alias("body")), *(F.struct(F.lit(i).alias("i"), F.to_json(F.col(role), {"ignoreNullFields": "false"}).alias("body")) for i, role in ((1, "sire"), (2, "dam"))))
    return rows.select("seq", F.explode(bodies).alias("m")).select((3 * F.col("seq") + F.col("m.i")).alias("mention"), F.col("m.body").alias("body")).where("body is not null")


def played(placed: DataFrame) -> dict[str, DataFrame]:
    """Tables of the blocks of ``placed(block, mention, body)``, each with ``block``, without parentage."""
    in_order = placed.select("block", "mention", "body").repartition("block").sortWithinPartitions("block", "mention")
    # by kind: each table is read from its own folder
    told = materialise(in_order.mapInArrow(_replay_sorted, OUTPUT), "told", partition_by=["kind"])
    table = lambda kind, ddl: told.where(F.col("kind") == kind).select("block", F.from_json("payload", ddl).alias("x")).select("block", "x.*")
    out = {name: table(name, ddl) for name, ddl in TABLES.items() if name != "parentage"}
    out["log"], out["fallen"] = table("log", "mention bigint, step bigint, uid string, rung string"), table("fallen", "mention bigint")
    renamed = materialise(table("renamed", "old string, uid string").select("old", F.col("uid").alias("now")), "renamed")
    home = table("mention", "mention bigint, uid string").join(renamed, F.col("uid") == F.col("old"), "left").select("block", "mention", F.coalesce("now", "uid").alias("uid"))
    out["mention"] = materialise(home, "homes")
    return out


def lines(home: DataFrame, fallen: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Lines of descent between where a record's mentions are: (child_uid, parent_uid, role), with the columns ``carried``
    of both ends as child_ and parent_."""
    ends = home.withColumn("seq", F.expr("mention div 3")).withColumn("role", F.pmod("mention", F.lit(3)))
    of = lambda end: [F.col(c).alias(f"{end}_{c}") for c in ("uid", *carried)]
    child = ends.where("role = 0").select("seq", *of("child"))
    stands = ends.where("role > 0").join(fallen.select("mention"), "mention", "left_anti")
    parent = stands.select("seq", *of("parent"), F.when(F.col("role") == 1, "SIRE").otherwise("DAM").alias("role"))
    return child.join(parent, "seq").drop("seq").distinct()


def replay(records: DataFrame, skip_steers: bool = False, preserve_affected: bool = False) -> dict[str, DataFrame]:
    """``records`` with ``seq`` to the graph's tables, plus ``log(mention, step, uid, rung)``,
    ``mention(mention, uid)`` and ``fallen(mention)``, the lines that fell."""
    rows = materialise(prepared(records, skip_steers, preserve_affected), "records")
    out = played(mentions_of(rows).join(mention_blocks(rows), "mention"))
    out = {name: df.drop("block") for name, df in out.items()}
    out["parentage"] = lines(out["mention"], out["fallen"])
    return out


def trace(records: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(seq, part, step, type, uid, detail) in the order in which a load does things: each record's start, the animals
    made and joined for it and its parents, and its end; ``write.json`` makes the file."""
    steps = tables["log"].select(F.expr("mention div 3").alias("seq"), F.lit(1).alias("part"), "step", F.when(F.col("rung") == "created", F.when(F.pmod("mention", F.lit(3)) == 0, "animal").otherwise("stub")).otherwise("merge").alias("type"), "uid", F.col("rung").alias("detail"))
    own = tables["mention"].where("pmod(mention, 3) = 0").select(F.expr("mention div 3").alias("seq"), "uid")
    none = F.lit(None).cast("string")
    starts = records.select("seq", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("step"), F.lit("record_start").alias("type"), none.alias("uid"), F.concat_ws(":", "association", "regNumber").alias("detail"))
    ends = own.select("seq", F.lit(2).alias("part"), F.lit(0).cast("bigint").alias("step"), F.lit("record_end").alias("type"), "uid", none.alias("detail"))
    return starts.unionByName(steps).unionByName(ends)


def stats(tables: dict[str, DataFrame]) -> DataFrame:
    """(rung, n): animals created and merges by rung of the ladder."""
    return tables["log"].groupBy("rung").agg(F.count("*").alias("n"))


def closure(mentions: DataFrame) -> DataFrame:
    """Set-based resolution of ``mentions(mention, key)``: (mention, entity), the least mention of each
    component over shared keys."""
    found = blocks(mentions.where("key is not null").distinct())
    return found.select("mention", F.col("block").alias("entity"))
