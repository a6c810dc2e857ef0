"""Resolution that keeps its blocks between loads, so that a load costs what it touches.

A folder holds, per load (``batch=k``), only what that load found or made anew:

* ``keys(key, block)``: keys that identify by themselves and the names and tattoos that were new, with the block that had
  them then; ``status(block, into)``: blocks that the load resolved (``into`` itself) or joined to another. Together a
  union-find whose root is found by following ``into``: blocks never come apart, and the least number stays the root;
* ``mentions(block, mention, body)`` and ``placed(block, ...facts)``: all of the blocks that it touched;
* the graph's tables of these blocks, and the lines of descent that have an end in one.

A row counts if its load is the last that its block was touched by (a line: the last of both its ends' blocks). Nothing
is rewritten, a load that comes again writes over its own folders, and a reader of load ``k`` sees none after it.

A new load meets the old blocks by its keys, takes from them facts, then bodies, of those it touches, joins and replays
these, and leaves all others unread. Lookups read only the hash buckets of what they look for. ``compacted`` writes what
counts as one load into another folder; do it when many loads have gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brandbook.operators import resolve
from brandbook.operators.components import connected_components
from brandbook.operators.ordered import numbered
from brandbook.schema import RESOLUTION, TABLES
from brandbook.session import exists, materialise

BUCKETS = 32
FACTS = "tattoo string, dob string, sex string, name string, specific boolean, dated boolean"
_FACT_NAMES = [c.split(" ")[0] for c in FACTS.split(", ")]
#: Tables that lookups go to, with the column that deals them to buckets.
LOOKED_UP = {
    "keys": ("key string, block bigint", "key"), "status": ("block bigint, into bigint", "block"),
    "mentions": ("block bigint, mention bigint, body string", "block"), "placed": (f"block bigint, {FACTS}", "block"),
    "mention": ("block bigint, seq bigint, mention bigint, uid string", "seq"),
}
KEPT = {name: f"block bigint, {ddl}" for name, ddl in {**TABLES, **RESOLUTION}.items() if name not in ("parentage", "mention")}
LINES = f"{TABLES['parentage']}, child_block bigint, child_batch int, parent_block bigint, parent_batch int"


def _marks(facts: DataFrame, node: str) -> DataFrame:
    """(node, key): tattoos and names as keys of the index; they lead to blocks that may join."""
    both = F.array(F.concat(F.lit("t:"), "tattoo"), F.concat(F.lit("n:"), "name"))
    return facts.select(node, F.explode(both).alias("key")).where("key is not null").distinct()


class BlockIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    # ---- tables

    def _bucket(self, by: str) -> Column:
        return F.pmod(F.xxhash64(by), F.lit(self.buckets)).cast("int")

    def _write(self, name: str, batch: int, df: DataFrame) -> None:
        path = f"{self.path}/{name}/batch={batch}"
        if name in LOOKED_UP:
            df.withColumn("bucket", self._bucket(LOOKED_UP[name][1])).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)

    def _rows(self, name: str, batch: int) -> DataFrame:
        """All rows of a table up to load ``batch``, those that don't count too."""
        ddl = LOOKED_UP[name][0] + ", batch int, bucket int" if name in LOOKED_UP else {**KEPT, "lines": LINES, "sizes": "n bigint"}[name] + ", batch int"
        if not exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{name}").where(F.col("batch") <= batch)

    def _look_up(self, name: str, wanted: DataFrame, batch: int, loads: list[int] | None = None) -> DataFrame:
        """The rows of a table for the values of ``wanted``, a written table of one column without repeats; of some ``loads`` only, if given."""
        (by,) = wanted.columns
        if not exists(self.spark, f"{self.path}/{name}"):  # nothing was loaded yet
            return self._rows(name, batch)
        touched = [r[0] for r in wanted.select(self._bucket(by)).distinct().collect()]  # numbers below ``buckets``
        rows = self._rows(name, batch) if loads is None else self._rows(name, batch).where(F.col("batch").isin(loads))
        return (rows if len(touched) == self.buckets else rows.where(F.col("bucket").isin(touched))).join(wanted, by)

    def _counting(self, name: str, of: DataFrame, batch: int) -> DataFrame:
        """The rows that count of blocks ``of(block, batch)``, as ``_roots`` gives them."""
        if not exists(self.spark, f"{self.path}/{name}"):
            return self._rows(name, batch).drop("batch", "bucket")
        wanted = materialise(of.select("block").distinct(), "wanted")
        loads = [r[0] for r in of.select("batch").distinct().collect()]  # no more than loads since the last compaction
        return self._look_up(name, wanted, batch, loads).join(of.select("block", "batch").distinct(), ["block", "batch"], "left_semi").drop("batch", "bucket")

    def _roots(self, blocks: DataFrame, batch: int) -> DataFrame:
        """(block, root, batch) of written ``blocks(block)``: the block that each is part of now, and the last load that touched that."""
        if not exists(self.spark, f"{self.path}/status"):
            return blocks.select("block", F.col("block").alias("root"), F.lit(-1).alias("batch")).where("false")
        found = blocks.select("block", F.col("block").alias("root"))
        while True:
            wanted = materialise(found.select(F.col("root").alias("block")).distinct(), "wanted")
            state = self._look_up("status", wanted, batch).groupBy("block").agg(F.max_by("into", "batch").alias("into"), F.max("batch").alias("batch"))
            found = materialise(found.select("block", "root").join(state.withColumnRenamed("block", "root"), "root").select("block", F.col("into").alias("root"), "batch", (F.col("into") != F.col("root")).alias("moved")), "roots")
            if found.where("moved").limit(1).count() == 0:
                return found.drop("moved")

    def _owners(self, keys: DataFrame, batch: int) -> DataFrame:
        """(key, block, batch): the blocks that have ``keys(key)`` now; a mark may be several blocks'."""
        if not exists(self.spark, f"{self.path}/keys"):
            return self._rows("keys", batch).select("key", "block", "batch")
        found = materialise(self._look_up("keys", keys, batch).select("key", "block").distinct(), "found")
        roots = self._roots(materialise(found.select("block").distinct(), "held"), batch)
        return found.join(roots, "block").select("key", F.col("root").alias("block"), "batch").distinct()

    # ---- loads

    def size(self, batch: int) -> int:
        """Records of the loads up to ``batch``."""
        return self._rows("sizes", batch).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def last(self) -> int | None:
        """The last load that is whole; ``sizes`` is what a load writes last."""
        return self._rows("sizes", (1 << 31) - 1).agg(F.max("batch")).first()[0]

    def add(self, records: DataFrame, batch: int, order: list[str], skip_steers: bool = False, preserve_affected: bool = False) -> None:
        """Load ``records`` without ``seq``, in ``order``, as load ``batch``, greater than all before."""
        before = batch - 1
        base = self.size(before)
        ranked = numbered(records, order)
        rows = materialise(resolve.prepared(ranked.withColumn("seq", F.col("seq") + base), skip_steers, preserve_affected), "records")
        known = materialise(resolve.facts(rows), "facts")
        keys = materialise(resolve.block_keys(rows), "keys")

        home, moved, placed = self._strong(keys, known, before)
        while True:
            marks = materialise(_marks(placed, "block").select("key").distinct(), "marks")
            beside = self._owners(marks, before).select("block", "batch").distinct().join(moved.select(F.col("old").alias("block")), "block", "left_anti")
            beside = materialise(beside, "beside")
            held = materialise(placed.unionByName(self._counting("placed", beside, before)), "placed")
            joined = materialise(connected_components(resolve.weak_links(held)), "joined")
            if joined.limit(1).count() == 0:
                break
            renamed = lambda df: df.join(joined, F.col("block") == F.col("node"), "left").withColumn("block", F.coalesce("component", "block")).drop("node", "component")
            met = beside.join(joined, F.col("block") == F.col("node")).select(F.col("block").alias("old"), "batch", F.col("component").alias("block"))
            home, moved = materialise(renamed(home), "home"), materialise(renamed(moved).unionByName(met), "moved")
            touched = held.join(placed.select("block").union(joined.select("node")).distinct(), "block", "left_semi")
            placed = materialise(renamed(touched).distinct(), "placed")

        olds = moved.select(F.col("old").alias("block"), "batch")
        stored = self._counting("mentions", olds, before).join(moved.select("old", F.col("block").alias("now")), F.col("block") == F.col("old"))
        bodies = resolve.mentions_of(rows).join(home, "mention").select("block", "mention", "body")
        self._write("mentions", batch, bodies.unionByName(stored.select(F.col("now").alias("block"), "mention", "body")))
        bodies = self._rows("mentions", batch).where(F.col("batch") == batch)
        self._write("placed", batch, placed)
        fresh = keys.unionByName(_marks(known, "mention")).join(home, "mention").select("key", "block").distinct()
        self._write("keys", batch, fresh)
        resolved = home.select("block").distinct().select("block", F.col("block").alias("into"))
        retired = moved.where("old <> block").select(F.col("old").alias("block"), F.col("block").alias("into"))
        self._write("status", batch, resolved.unionByName(retired))
        self._write_graph(resolve.played(bodies), batch)
        self._write("sizes", batch, records.agg(F.count("*").alias("n")))

    def _strong(self, keys: DataFrame, known: DataFrame, before: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """By keys that identify: ``home(mention, block)`` of the new mentions, ``moved(old, batch, block)`` of the old blocks that
        they meet, and ``placed`` facts of both."""
        owners = materialise(self._owners(materialise(keys.select("key").distinct(), "wanted"), before), "owners")
        met = keys.join(owners, "key").select(F.col("mention").alias("a"), F.col("block").alias("b"))
        found = materialise(connected_components(resolve.linked(keys, "mention").union(met)), "found")
        nodes = keys.select("mention").union(known.select("mention")).distinct()
        home = materialise(nodes.join(found, F.col("mention") == F.col("node"), "left").select("mention", F.coalesce("component", "mention").alias("block")), "home")
        olds = owners.select(F.col("block").alias("old"), "batch").distinct()
        moved = materialise(olds.join(found, F.col("old") == F.col("node")).select("old", "batch", F.col("component").alias("block")), "moved")
        own = known.join(home, "mention").select("block", *_FACT_NAMES)
        old = self._counting("placed", moved.select(F.col("old").alias("block"), "batch"), before)
        theirs = old.join(moved.select("old", F.col("block").alias("now")), F.col("block") == F.col("old")).select(F.col("now").alias("block"), *_FACT_NAMES)
        return home, moved, materialise(own.unionByName(theirs).distinct(), "placed")

    def _write_graph(self, new: dict[str, DataFrame], batch: int) -> None:
        for name in KEPT:
            self._write(name, batch, new[name])
        self._write("mention", batch, new["mention"].withColumn("seq", F.expr("mention div 3")))
        own = self._rows("mention", batch).where(F.col("batch") == batch).drop("bucket")
        # the other ends of lines: mentions of the same records in blocks that weren't touched
        seqs = materialise(own.select("seq").distinct(), "seqs")
        others = materialise(self._look_up("mention", seqs, batch - 1).drop("bucket").join(own.select("mention"), "mention", "left_anti"), "others")
        last = self._roots(materialise(others.select("block").distinct(), "held"), batch).where("root = block").select("block", "batch")
        ends = own.unionByName(others.join(last, ["block", "batch"], "left_semi"))
        self._write("lines", batch, resolve.lines(ends, new["fallen"], ("block", "batch")).select(*(c.strip().split(" ")[0] for c in LINES.split(","))))

    # ---- reads

    def _current(self, batch: int) -> DataFrame:
        """(block, batch): all blocks as of load ``batch`` and the last load that touched each."""
        state = self._rows("status", batch).groupBy("block").agg(F.max_by("into", "batch").alias("into"), F.max("batch").alias("batch"))
        return state.where("into = block").select("block", "batch")

    def tables(self, batch: int) -> dict[str, DataFrame]:
        """The graph's tables and those of the resolution as of load ``batch``: what a replay of all its records gives."""
        current = self._current(batch)
        own = lambda name: self._rows(name, batch).join(current, ["block", "batch"], "left_semi")
        out = {name: own(name).drop("block", "batch") for name in KEPT}
        out["mention"] = own("mention").select("mention", "uid")
        rows = self._rows("lines", batch)
        for end in ("child", "parent"):
            rows = rows.join(current.toDF(f"{end}_block", f"{end}_batch"), [f"{end}_block", f"{end}_batch"], "left_semi")
        out["parentage"] = rows.select("child_uid", "parent_uid", "role").distinct()
        return out

    def compacted(self, path: str, batch: int) -> BlockIndex:
        """What counts as of load ``batch``, written as that one load to an empty folder; loads go on from there."""
        new, current = BlockIndex(self.spark, path, self.buckets), materialise(self._current(batch), "current")
        own = lambda name: self._rows(name, batch).join(current, ["block", "batch"], "left_semi").drop("batch", "bucket")
        for name in ("mentions", "placed", "mention", *KEPT):
            new._write(name, batch, own(name))
        new._write("status", batch, current.select("block", F.col("block").alias("into")))
        keys = materialise(self._rows("keys", batch).select("key", "block").distinct(), "keys")
        roots = self._roots(materialise(keys.select("block").distinct(), "held"), batch)
        new._write("keys", batch, keys.join(roots, "block").select("key", F.col("root").alias("block")).distinct())
        lines = self._rows("lines", batch)
        for end in ("child", "parent"):
            lines = lines.join(current.toDF(f"{end}_block", f"{end}_batch"), [f"{end}_block", f"{end}_batch"], "left_semi")
        new._write("lines", batch, lines.drop("batch").withColumn("child_batch", F.lit(batch)).withColumn("parent_batch", F.lit(batch)))
        new._write("sizes", batch, self._rows("sizes", batch).agg(F.sum("n").alias("n")))
        return new
