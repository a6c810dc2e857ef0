"""Progress over time: newest readings, thinning, carried-forward sums, boards and health."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brandbook.functions import norm
from brandbook.operators.ordered import ordered, running_sums, scanned
from brandbook.session import materialise

#: (age in seconds up to which, step in seconds); the last has no bound.
STEPS = ((86_400, 600), (14 * 86_400, 3_600), (None, 21_600))
MOST_POINTS = 700
FINEST = 600
CRAWL_STALE, LOAD_STALE, HEARTBEAT_STALE = 300, 600, 20


def newest(rows: DataFrame, key: str | list[str], at: str, order: str) -> DataFrame:
    """The row with the greatest ``at`` of each key (null counts as least); of equal ones the first by ``order``.

    Two grouped maxima, each partial in every task, so a key with very many rows is never sorted in one."""
    keys = [key] if isinstance(key, str) else key
    value = F.coalesce(F.col(at).cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in keys))
    best = rows.groupBy(*keys, value.alias("_at")).agg(F.min_by(row, F.col(order)).alias("_row"))
    return best.groupBy(*keys).agg(F.max_by("_row", "_at").alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def step_of(age: Column) -> Column:
    out = F.lit(STEPS[-1][1])
    for most, step in reversed(STEPS[:-1]):
        out = F.when(age <= most, step).otherwise(out)
    return out


def compact(points: DataFrame, now: Column, t: str = "t", most: int = MOST_POINTS) -> DataFrame:
    """The newest point of each bucket, whose width grows with age; the latest ``most`` of them."""
    step = step_of(F.greatest(F.lit(0), now - F.col(t)))
    rows = points.withColumn("_step", step).withColumn("_bucket", F.expr(f"{t} div _step"))
    kept = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_step", "_bucket").orderBy(F.desc(t)))).where("_n = 1").drop("_n", "_step", "_bucket")
    return kept.orderBy(F.desc(t)).limit(most)


def _jumps(t: np.ndarray, every: int) -> np.ndarray:
    """Of each time the place of the first one ``every`` later, itself where there is none."""
    found = np.searchsorted(t, t + every, "left")
    return np.where(found < len(t), found, np.arange(len(t)))


def _segments(batch: pa.Table, key: str, t: str):
    """(key, first row, times) of each key of a table sorted by key and time."""
    keys, times = batch.column(key).combine_chunks(), batch.column(t).combine_chunks().to_numpy(zero_copy_only=False)
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1]) if len(codes) else []
    for a, b in zip(starts, [*starts[1:], len(codes)], strict=True):
        yield keys[int(a)].as_py(), int(a), times[a:b]


def _entries(key: str, t: str, every: int):
    """Of each key's stretch in a partition: where a walk may enter it, and the last point that it keeps there then."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        part = table.column("_part")[0].as_py()
        rows: list[tuple] = []
        for name, _, times in _segments(table, key, t):
            jump = _jumps(times, every)
            last = jump
            while (further := last[last] != last).any():  # pointers are doubled until all stand
                last = np.where(further, last[last], last)
            near = min(len(times), np.searchsorted(times, times[0] + every, "left") + 1)
            rows += [(name, part, int(times[i]), int(times[last[i]])) for i in range(near)]
        kinds = [table.schema.field(key).type, pa.int32(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[key, "part", "entry", "exit"])

    return run


def _walk(key: str, t: str, every: int):
    """The rows that a walk keeps that enters each key's stretch in a partition at its ``_entry``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        entries, kept = table.column("_entry"), []
        for _, first, times in _segments(table, key, t):
            jump, at = _jumps(times, every), int(np.searchsorted(times, entries[first].as_py(), "left"))
            kept.append(first + at)
            while jump[at] != at:
                at = int(jump[at])
                kept.append(first + at)
        return table.take(pa.array(kept, pa.int64())).drop(["_part", "_id", "_entry"])

    return run


def sample(points: DataFrame, key: str, t: str, every: int = FINEST) -> DataFrame:
    """The points kept if each is kept only ``every`` seconds or more after the last kept one of its key, by whole
    seconds ``t``. Which those are depends on the data before, so it is a walk of jumps to the first point ``every`` later.

    No task walks a whole key. Points are range-sorted, and each partition works out where a walk leaves its
    stretch of a key for each point at which one may enter it: that is within ``every`` of the stretch's first, since the
    point kept before lies ahead of that, so it tells at most ``every`` + 1 places and not its points. On the table of these
    places jumps are doubled from each key's first point, in as many joins as the number of partitions has binary
    digits; then each partition walks from where it is entered. Points without a time are left out, of equal times one stays."""
    rows = points.where(F.col(t).isNotNull()).dropDuplicates([key, t]).withColumn(t, F.col(t).cast("bigint"))
    kept = ordered(rows, [key, t])
    kind = rows.schema[key].dataType.simpleString()
    found = materialise(kept.select("_part", "_id", key, t).groupBy("_part").applyInArrow(_entries(key, t, every), f"`{key}` {kind}, part int, entry bigint, exit bigint"), "entries")
    same = lambda a, b: F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}"))
    # of each place the first place that is ``every`` after its exit, in one sorted walk over places and goals together
    places = found.select(key, F.col("entry").alias("at"), F.lit(None).cast("bigint").alias("goal"))
    goals = found.select(key, (F.col("exit") + every).alias("at"), F.col("entry").alias("goal"))
    ahead = Window.partitionBy(key).orderBy(F.desc("at"), F.col("goal").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = places.withColumn("place", F.col("at")).unionByName(goals.withColumn("place", F.lit(None).cast("bigint")))
    nexts = both.withColumn("next", F.last("place", ignorenulls=True).over(ahead))
    jumps = materialise(nexts.where("goal is not null and next is not null").select(key, F.col("goal").alias("entry"), "next"), "jumps")
    reached = materialise(found.groupBy(key).agg(F.min("entry").alias("entry")), "reached")
    while True:
        on = reached.alias("r").join(jumps.alias("j"), same("r", "j") & (F.col("r.entry") == F.col("j.entry")))
        new = on.select(f"r.{key}", F.col("j.next").alias("entry"))
        grown = materialise(reached.union(new).distinct(), "reached")
        if grown.count() == reached.count():
            break
        reached = grown
        twice = jumps.alias("a").join(jumps.alias("b"), same("a", "b") & (F.col("a.next") == F.col("b.entry")))
        jumps = materialise(twice.select(f"a.{key}", "a.entry", "b.next"), "jumps")
    # the entry of each stretch: of what is reached the least in it
    inside = reached.alias("r").join(found.alias("f"), same("r", "f") & (F.col("r.entry") == F.col("f.entry")))
    entered = materialise(inside.groupBy(F.col(f"f.{key}").alias(key), "f.part").agg(F.min("r.entry").alias("_entry")), "entered")
    walked = kept.alias("k").join(F.broadcast(entered).alias("e"), same("k", "e") & (F.col("k._part") == F.col("e.part"))).select("k.*", "e._entry")
    schema = kept.drop("_part", "_id").schema
    return walked.groupBy("_part").applyInArrow(_walk(key, t, every), schema).select(*points.columns)


def carried_forward(readings: DataFrame, key: str = "association", t: str = "t") -> DataFrame:
    """(t, done, pending): at every time the sum of each key's latest reading; times with nothing are left out.

    A reading changes the sum by its difference from the key's one before, so the sum is a running sum of the
    differences of each time, and no grid of times and keys is built."""
    rows = scanned(readings.select(key, t, "done", "pending"), key, [t], ("done", "pending"))
    change = [(F.col(c) - F.coalesce(f"prev_{c}", F.lit(0))).alias(c) for c in ("done", "pending")]
    moves = rows.select(t, *change).groupBy(t).agg(F.sum("done").alias("done"), F.sum("pending").alias("pending"))
    return running_sums(moves, t, ["done", "pending"]).where("done <> 0 or pending <> 0")


def rates(readings: DataFrame, key: str = "association", t: str = "t", done: str = "done", digits: int = 2) -> DataFrame:
    """Done per minute since the reading before."""
    rows = scanned(readings, key, [t], (t, done))
    gap = F.col(t) - F.col(f"prev_{t}")
    rate = F.when(gap > 0, F.round((F.col(done) - F.col(f"prev_{done}")) / gap * 60, digits))
    return rows.withColumn("rate_per_min", rate).drop(f"prev_{t}", f"prev_{done}")


def eta_days(pending: Column, rate: Column) -> Column:
    return F.when(rate > 0, F.round(pending / rate / 60 / 24, 1))


def boards(entries: DataFrame, graph: DataFrame | None, now: Column) -> DataFrame:
    """The board of each association: ``entries(association, done, pending, failed, rate_per_min, updated_at)``
    with ageSec, stale and etaDays, and from ``graph(association, registrations, behind)`` graphed and behind."""
    age = norm.age_seconds(F.col("updated_at"), now)
    rows = entries.withColumn("ageSec", age).withColumn("stale", age.isNull() | (age > CRAWL_STALE)).withColumn("etaDays", eta_days(F.col("pending"), F.col("rate_per_min")))
    if graph is None:
        return rows.withColumns({"graphed": F.lit(None).cast("long"), "behind": F.lit(None).cast("long")})
    return rows.join(graph.select("association", F.col("registrations").alias("graphed"), "behind"), "association", "left")


def totals(board: DataFrame) -> DataFrame:
    """One row: sums, the longest leg (legs run side by side, so they don't add up), and what waits to load."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("done", "pending", "failed", "behind")]
    return board.agg(*sums, F.max("etaDays").alias("etaDaysOverall"))


def rollup(board: DataFrame) -> DataFrame:
    """Sums per association and, with a null association, of all."""
    return board.rollup("association").agg(*(F.sum(c).alias(c) for c in ("done", "pending", "failed")))


def load_progress(real: DataFrame, loadable: DataFrame) -> DataFrame:
    """(association, written, remaining, pct) from counts ``(association, n)`` in the graph and in the files."""
    both = loadable.withColumnRenamed("n", "loadable").join(real.withColumnRenamed("n", "real"), "association", "left")
    written = F.least(F.coalesce("real", F.lit(0)), F.col("loadable"))
    rows = both.select("association", written.alias("written"), F.greatest(F.col("loadable") - written, F.lit(0)).alias("remaining"), "loadable")
    return rows.select("association", "written", "remaining", F.when(F.col("loadable") > 0, F.least(F.lit(100.0), F.round(F.col("written") / F.col("loadable") * 100, 1))).otherwise(F.lit(0.0)).alias("pct"))


def lag_records(behind_bytes: Column, offset: Column, loaded: Column) -> Column:
    """Records not yet loaded, from the mean length of those loaded: 0 if none is behind, null if unknown."""
    return F.when(behind_bytes == 0, F.lit(0)).when((offset > 0) & (loaded > 0), F.floor(behind_bytes / (offset / loaded)))


def file_lag(offsets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(association, behind_bytes, behind) from ``offsets(association, offset, loaded)`` and ``sizes(association, size)``."""
    behind = F.greatest(F.lit(0), F.col("size") - F.coalesce("offset", F.lit(0)))
    rows = sizes.join(offsets, "association", "left").withColumn("behind_bytes", behind)
    return rows.select("association", "behind_bytes", lag_records(F.col("behind_bytes"), F.col("offset"), F.col("loaded")).alias("behind"))


def state_label(alive: Column, stopped: Column, state: Column, age: Column) -> Column:
    """running if its process lives, stopped if told so or by its own word, running by a fresh heartbeat, else idle."""
    return F.when(alive, "running").when(stopped | (state == "stopped"), "stopped").when(age <= HEARTBEAT_STALE, "running").otherwise("idle")


def loading(ok: Column, read_at: Column, now: Column) -> Column:
    age = norm.age_seconds(read_at, now)
    return F.coalesce(ok & age.isNotNull() & (age < CRAWL_STALE), F.lit(False))


def problems(crawl: DataFrame, lag: DataFrame, load_age: int | None = None) -> DataFrame:
    """(association, problem) of all that isn't as it should be: ``crawl(association, error, age, unit)`` and
    ``lag(association, behind)``."""
    silent = F.col("age").isNull() | (F.col("age") > CRAWL_STALE)
    first = F.when(F.col("error").isNotNull(), "unreadable status file").when(silent, "crawler silent").when(~F.col("unit").isin("active", "?"), F.concat(F.lit("unit is "), "unit"))
    found = [crawl.select("association", first.alias("problem")), lag.select("association", F.when(F.col("behind") > 5000, "not yet in the graph").alias("problem"))]
    if load_age is not None:
        found.append(lag.sparkSession.range(1).select(F.lit(None).cast("string").alias("association"), F.when(F.lit(load_age) > LOAD_STALE, "loader has not advanced").alias("problem")))
    return reduce(DataFrame.unionAll, found).where("problem is not null")


def heartbeats(queue: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """What a crawler tells of itself: ``runs(association, state, current, processed, elapsed)`` with the counts of its
    ``queue(association, status)``, rate_per_min, pct and updated_at; ``records.snapshot`` writes it."""
    counts = queue.groupBy("association", "status").agg(F.count("*").alias("n")).groupBy("association").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("counts"))
    rows = runs.join(counts, "association", "left")
    of = lambda k: F.coalesce(F.try_element_at("counts", F.lit(k)), F.lit(0))
    return rows.select("association", "state", "current", "counts", "processed", norm.rate_per_minute(F.col("processed"), F.col("elapsed")).alias("rate_per_min"), norm.percent_done(of("done"), of("pending")).alias("pct"), now.alias("updated_at"))


#: What a status may publish, and what of its current animal.
PUBLIC = ("association", "state", "done", "pending", "failed", "processed", "rate_per_min", "pct", "updated_at")
PUBLIC_CURRENT = ("association", "reg", "name")


def published(status: DataFrame) -> DataFrame:
    """The allow-listed fields of status rows; associations that never ran are hidden."""
    count = lambda c: F.coalesce(F.try_element_at("counts", F.lit(c)), F.lit(0)).alias(c)
    rows = status.select(
        "association", "state", count("done"), count("pending"), count("failed"), "processed", "rate_per_min", "pct", "updated_at",
        F.when(F.col("current").isNotNull(), F.struct(*(F.col(f"current.{c}") for c in PUBLIC_CURRENT))).alias("current"),
    )
    return rows.where((F.col("done") > 0) | (F.col("state") == "running"))


def payload_error(payload: Column, allowed: list[str], numeric: list[str], code: str | None = None, pattern: str = r"^[A-Z]{2,10}$") -> Column:
    """Why a map of texts isn't acceptable, or null: unknown fields, then a bad code, then values that aren't numbers."""
    extra = F.array_sort(F.array_except(F.map_keys(payload), F.array(*map(F.lit, allowed))))
    bad = F.filter(F.array(*map(F.lit, numeric)), lambda k: F.try_element_at(payload, k).isNotNull() & F.try_element_at(payload, k).try_cast("double").isNull()) if numeric else F.array().cast("array<string>")
    out = F.when(F.size(extra) > 0, F.concat(F.lit("unexpected field: "), extra[0]))
    if code:
        out = out.when(~F.coalesce(F.try_element_at(payload, F.lit(code)).rlike(pattern), F.lit(False)), "bad code")
    return out.when(F.size(bad) > 0, F.concat(F.lit("not a number: "), F.get(bad, F.lit(0))))


def may_replace(old: DataFrame, new: DataFrame, force: bool = False) -> bool:
    """An empty board doesn't replace one with readings, unless forced."""
    return force or new.limit(1).count() > 0 or old.limit(1).count() == 0


def trend(series: DataFrame, t: str = "t", most: int = 24) -> DataFrame:
    """The latest rows of a series, newest first."""
    return series.orderBy(F.desc(t)).limit(most)


def newest_graph(entries: DataFrame) -> DataFrame:
    """Of ``entries(source, publishedAt, graph)`` the graph reading of the latest publisher that has one."""
    return entries.where("graph is not null").agg(F.max_by("graph", "publishedAt").alias("graph"), F.max("publishedAt").alias("publishedAt"))


def graph_snapshot(tables: dict[str, DataFrame], now: Column, error: Column | None = None) -> DataFrame:
    """One row of a graph's counts that may be published: animals, registrations that aren't stubs, animals in several
    registries, polled ones, and defects by status. Of an error only that there is one is told."""
    animals = tables["animal"].agg(F.count("*").alias("animals"), F.count(F.when(F.col("horn_status") == "Polled", 1)).alias("polled"))
    papers = tables["registration"].agg(F.count(F.when(~F.coalesce("stub", F.lit(False)), 1)).alias("registrations"))
    several = tables["registration"].groupBy("uid").agg(F.countDistinct("association").alias("n")).agg(F.count(F.when(F.col("n") > 1, 1)).alias("multi"))
    defects = tables["animal_defect"].groupBy(F.coalesce("status", F.lit("Unknown")).alias("status")).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("defects"))
    rows = animals
    for one in (papers, several, defects):  # one row each
        rows = rows.join(F.broadcast(one), F.lit(True))
    told = F.lit(None).cast("string") if error is None else F.when(error.isNotNull(), "error")
    return rows.withColumns({"publishedAt": now, "error": told})


def merged_boards(entries: DataFrame) -> DataFrame:
    """One board per association out of ``entries(source, boards array<struct<association, ..., updated_at>>)``:
    the newest reading, of equally new ones the first listed."""
    rows = entries.select("source", F.posexplode("boards").alias("at", "b")).select("source", "at", "b.*").where("association is not null")
    return newest(rows.withColumn("_o", F.struct("source", "at")), "association", "updated_at", "_o").drop("_o", "at")
