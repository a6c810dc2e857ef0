"""Scans over a global order or along a key, without a task that sees all rows or all of one key.

Rows are range-sorted into partitions, each works out its own part, and what the partitions before it add up to
comes from a table of one row a partition. A key with a third of all rows lies on a third of the partitions: what it
carries from one to the next (its last row, the place where its run began) is in that table too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandbook.session import materialise


def ordered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` range-sorted, with the partition's number and a rising id as columns; written, so that both stay."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "ordered")


def _before(column: str):
    """What the partitions before add up to; the window is over one row a partition."""
    return F.coalesce(F.sum(column).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(rows: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """``rows`` with ``seq``, or another ``name``, from 0 in ``order``."""
    kept = ordered(rows, order)
    sizes = kept.groupBy("_part").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    starts = sizes.select("_part", "_first", _before("n").alias("_start"))
    return kept.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_id") - F.col("_first")).drop("_part", "_id", "_first", "_start")


def running_sums(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """``rows``, of which no two have the same ``order``, with ``columns`` replaced by their sums so far."""
    kept = ordered(rows, [order])
    totals = kept.groupBy("_part").agg(*(F.sum(c).alias(f"_t_{c}") for c in columns))
    starts = totals.select("_part", *(_before(f"_t_{c}").alias(f"_s_{c}") for c in columns))
    own = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = {c: F.sum(c).over(own) + F.col(f"_s_{c}") for c in columns}
    return kept.join(F.broadcast(starts), "_part").withColumns(sums).drop("_part", "_id", *(f"_s_{c}" for c in columns))


def scanned(rows: DataFrame, key: str, order: list[str], previous: tuple[str, ...] = (), flag: Column | None = None) -> DataFrame:
    """``rows`` with, along each ``key`` in ``order``, ``prev_<c>`` for the columns ``previous``: the value in the row before
    (null in the first), and, with a ``flag``, ``run``: how many rows in a row it has held up to this one.

    A segmented scan: a partition finds out all but what its first key carries over from the partition before, and the
    table of partitions tells that. A null key is a key; ties in ``order`` keep the order in which they were sorted."""
    if flag is not None:
        rows = rows.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    kept = ordered(rows, [key, *order])
    own = Window.partitionBy("_part").orderBy("_id")
    mark = F.struct(F.col(key).alias("k"), *(F.col(c).alias(f"p_{c}") for c in previous))
    kept = kept.withColumn("_mark", mark).withColumn("_before", F.lag("_mark").over(own))
    if flag is not None:
        # where the run that a row is in began, as the id of the row before it; the partition's first row is told below
        cut = F.when(~F.col("_flag"), F.col("_id")).when(F.col("_before").isNotNull() & ~F.col("_before.k").eqNullSafe(F.col("_mark.k")), F.col("_id") - 1)
        kept = kept.withColumn("_cut", F.max(cut).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    kept = materialise(kept, "scanned")

    told = [F.min_by("_mark", "_id").alias("_first_mark"), F.max_by("_mark", "_id").alias("_last_mark"), F.min("_id").alias("_first_id"), F.max("_id").alias("_last_id")]
    parts = kept.groupBy("_part").agg(*told, *([F.max("_cut").alias("_last_cut")] if flag is not None else []))
    line = Window.orderBy("_part")  # one row a partition
    parts = parts.withColumn("_carry", F.lag("_last_mark").over(line))
    goes_on = F.coalesce(F.col("_carry.k").eqNullSafe(F.col("_first_mark.k")), F.lit(False)) & F.col("_carry").isNotNull()
    if flag is not None:
        # how long the run is that a partition ends in: all of it, where nothing cuts it, and then that of the one before too.
        # Lengths add along partitions until a cut: sums of whole ones, less those up to the last that was cut
        cut_at = F.when(F.col("_last_cut").isNotNull(), F.col("_last_cut")).when(~F.col("_goes_on"), F.col("_first_id") - 1)
        parts = parts.withColumn("_goes_on", goes_on).withColumn("_size", F.col("_last_id") - F.col("_first_id") + 1)
        parts = parts.withColumn("_total", F.sum("_size").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_cut_at", cut_at)
        # rows from the beginning of all up to the cut, the greatest of which is the last
        until = F.when(F.col("_cut_at").isNotNull(), F.col("_total") - (F.col("_last_id") - F.col("_cut_at")))
        parts = parts.withColumn("_until", F.max(until).over(line.rowsBetween(Window.unboundedPreceding, 0)))
        carried = F.coalesce(F.lag("_total").over(line) - F.lag("_until").over(line), F.lit(0))
        parts = parts.withColumn("_carried", F.when(F.col("_goes_on"), carried).otherwise(0))
    else:
        parts = parts.withColumn("_goes_on", goes_on)
    parts = parts.select("_part", "_first_id", "_carry", "_goes_on", *(["_carried"] if flag is not None else []))

    joined = kept.join(F.broadcast(parts), "_part")
    first = F.col("_id") == F.col("_first_id")
    before = F.when(first & F.col("_goes_on"), F.col("_carry")).when(~first & F.col("_before.k").eqNullSafe(F.col("_mark.k")), F.col("_before"))
    out = joined.withColumns({f"prev_{c}": before[f"p_{c}"] for c in previous})
    if flag is not None:
        reach = F.when(F.col("_cut").isNotNull(), F.col("_id") - F.col("_cut")).otherwise(F.col("_id") - F.col("_first_id") + 1 + F.col("_carried"))
        out = out.withColumn("run", F.when(F.col("_flag"), reach).otherwise(0))
    return out.drop("_part", "_id", "_mark", "_before", "_cut", "_flag", "_first_id", "_carry", "_goes_on", "_carried")
