"""The queue of animals to visit, as a table that each step replaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brandbook.operators.ordered import scanned
from brandbook.session import materialise

KEYS = ["association", "reg_number"]
BACKOFF_STEP, MOST_BACKOFF, STOP_AFTER = 30, 300, 5


def seeded(queue: DataFrame, seeds: DataFrame, depth: int = 0, now: Column | None = None) -> DataFrame:
    """``seeds(association, reg_number, priority[, discovered_from])`` added. A known animal stays as it is, but
    for its priority, which only rises; of repeated seeds the highest priority counts, and the least source."""
    source = F.min("discovered_from") if "discovered_from" in seeds.columns else F.lit(None).cast("string")
    new = seeds.groupBy(F.upper("association").alias("association"), F.trim("reg_number").alias("reg_number")).agg(F.max("priority").alias("p"), source.alias("src"))
    both = queue.join(new, KEYS, "full")
    fresh = F.col("status").isNull()
    return both.select(
        *KEYS, F.coalesce("status", F.lit("pending")).alias("status"), F.when(fresh, depth).otherwise(F.col("depth")).cast("int").alias("depth"), F.coalesce(F.greatest("priority", "p"), F.lit(0)).cast("int").alias("priority"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"), "last_error", F.when(fresh, F.col("src")).otherwise(F.col("discovered_from")).alias("discovered_from"),
        F.when(fresh, (F.lit(None) if now is None else now).cast("string")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def unknown(items: DataFrame, queue: DataFrame) -> DataFrame:
    return items.join(queue, KEYS, "left_anti")


def pick(queue: DataFrame, n: int = 1) -> DataFrame:
    """The next ones: highest priority, least depth, fewest attempts; ties by key."""
    return queue.where("status = 'pending'").orderBy(F.desc("priority"), "depth", "attempts", *KEYS).limit(n)


def visited(queue: DataFrame, outcomes: DataFrame, now: Column, most_attempts: int = 3) -> DataFrame:
    """The queue after ``outcomes(association, reg_number, outcome, error)``: done, skipped, failed (again
    pending until ``most_attempts``), or refused, which changes nothing."""
    got = outcomes.select(*KEYS, "outcome", "error")
    both = queue.join(got, KEYS, "left")
    tries = F.col("attempts") + F.when(F.col("outcome") == "failed", 1).otherwise(0)
    status = F.when(F.col("outcome").isin("done", "skipped"), F.col("outcome")).when(F.col("outcome") == "failed", F.when(tries >= most_attempts, "failed").otherwise("pending")).otherwise(F.col("status"))
    changed = F.col("outcome").isin("done", "skipped", "failed")
    return both.select(
        *KEYS, status.alias("status"), "depth", "priority", tries.alias("attempts"), F.when(F.col("outcome") == "failed", F.substring("error", 1, 500)).otherwise(F.col("last_error")).alias("last_error"),
        "discovered_from", F.when(changed, now.cast("string")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def reset(queue: DataFrame, status: str) -> DataFrame:
    """Failed or skipped ones are pending again, with no attempts counted."""
    hit = F.col("status") == status
    return queue.withColumn("attempts", F.when(hit, 0).otherwise(F.col("attempts"))).withColumn("status", F.when(hit, "pending").otherwise(F.col("status")))


def parked(queue: DataFrame, scope: str, now: Column) -> DataFrame:
    """Pending ones of other associations are skipped."""
    hit = (F.col("status") == "pending") & (F.col("association") != scope.upper())
    return queue.withColumn("updated_at", F.when(hit, now.cast("string")).otherwise(F.col("updated_at"))).withColumn("status", F.when(hit, "skipped").otherwise(F.col("status")))


def status_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count("*").alias("n"))


def pending_by_association(queue: DataFrame) -> DataFrame:
    return queue.where("status = 'pending'").groupBy("association").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "association")


def breadth_first(neighbours: DataFrame, seeds: DataFrame, max_depth: int, scope: Column | None = None) -> DataFrame:
    """(node, depth) of all that ``seeds(node)`` reach by ``neighbours(node, next)`` in at most ``max_depth``
    steps, at their least depth. ``scope`` is a condition on a node; others aren't followed or kept."""
    seen = front = materialise(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "level")
    for depth in range(1, max_depth + 1):
        found = front.join(neighbours, "node").select(F.col("next").alias("node")).distinct()
        found = found if scope is None else found.where(scope)
        front = materialise(found.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)), "level")
        seen = seen.unionByName(front)
    return seen


def refusal_streaks(visits: DataFrame, key: str, order: list[str], refused: Column, retry_after: Column | None = None) -> DataFrame:
    """``visits`` with streak (refusals in a row so far), wait (seconds: what the host asks, else 30 a refusal,
    300 at most) and stop (five in a row). A host with any share of the visits is on many tasks."""
    rows = scanned(visits, key, order, flag=refused).withColumnRenamed("run", "streak")
    asked = F.lit(None).cast("int") if retry_after is None else retry_after
    wait = F.when(F.col("streak") > 0, F.coalesce(asked, F.least(BACKOFF_STEP * F.col("streak"), F.lit(MOST_BACKOFF)))).otherwise(0)
    return rows.withColumn("wait", wait).withColumn("stop", F.col("streak") >= STOP_AFTER)


def allowed(queue: DataFrame, rules: DataFrame, url: Column) -> DataFrame:
    """``queue`` without addresses that the longest fitting of ``rules(prefix, allow)`` forbids; no rule allows.

    An address meets rules by its own beginnings, those as long as some rule, so this is an equi-join and not a
    comparison of all with all. The lengths of rules are a handful of numbers."""
    lengths = sorted(r.n for r in rules.where("prefix is not null").select(F.length("prefix").alias("n")).distinct().collect())
    rows = queue.withColumn("_url", url)
    if not lengths:
        return rows.drop("_url")
    own = F.filter(F.array(*(F.substring("_url", 1, n) for n in lengths)), lambda p: p.isNotNull())
    prefixes = rows.select("_url").distinct().select("_url", F.explode(F.array_distinct(own)).alias("prefix"))
    verdict = prefixes.join(rules, "prefix").groupBy("_url").agg(F.max_by("allow", F.length("prefix")).alias("_allow"))
    return rows.join(verdict.where("not _allow").select("_url"), "_url", "left_anti").drop("_url")
