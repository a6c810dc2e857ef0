"""Mixing sources to target weights by Poisson replication.

A source with n of the N documents and weight w of the weights' sum W gets the repetition rate
``w / W * total / n`` (total: N unless given). Each document's count is the inverse of the Poisson
distribution with that rate at a number in (0, 1) that is a hash of seed and doc_id, so a count doesn't
depend on partitions, order or other documents, and a lost task gives the same rows again. Documents are
repeated count times (0: left out, as the rate says) and the copies are shuffled globally: dealt to
partitions by a hash of seed, doc_id and copy, and sorted by it.

Only counts per source are aggregated (a partial count in each task); the table of rates, one row a source,
is written before it is joined, so Spark broadcasts it if its measured size allows and otherwise joins by
source with skewed sources split.

Edge cases: a null source is a source of its own; a null doc_id is hashed as an empty string; repeated rows
have equal counts; a text's length doesn't matter; sources with no weight, or weight 0, get no copies; an
empty table gives no rows; a column of ``docs`` named copy or mix_key is replaced.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, functions as F

from brandbook.session import materialise

SEED = "mix-1"
TEMPERATURE = 0.5
#: With given weights rates above this are refused: a document repeated so often is a mistake in the weights.
MOST_RATE = 1000.0
#: Above this rate the distribution isn't listed from 0.
LISTED = 1000.0


def uniform(seed: str, key: Column) -> Column:
    """A number in (0, 1) with 52 bits, from MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def first_listed(rate: Column) -> Column:
    """Where the list of ``cumulative`` starts: 0, or for large rates twelve deviations below the rate, where
    the distribution function is far below the least number that ``uniform`` gives."""
    return F.when(rate > LISTED, F.floor(rate - 12 * F.sqrt(rate))).otherwise(F.lit(0)).cast("int")


def cumulative(rate: Column) -> Column:
    """The Poisson distribution function from ``first_listed`` on as far as doubles can tell it from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    k0 = first_listed(rate)
    k = k0.cast("double")
    # Stirling's series, exact in doubles for the starts of large rates
    start = F.when(k0 > 0, k * F.log(rate / k) - (rate - k) - F.log(2 * pi * k) / 2 - 1 / (12 * k) + 1 / (360 * k * k * k)).otherwise(-rate)
    first = F.struct(start.alias("log_p"), F.exp(start).alias("f"), F.array(F.exp(start)).alias("all"))

    def add(so_far: Column, k: Column) -> Column:
        log_p = so_far["log_p"] + F.log(rate) - F.log(k.cast("double"))
        f = so_far["f"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), f.alias("f"), F.concat(so_far["all"], F.array(f)).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(k0 + 1, last), first, add, lambda s: s["all"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, total: float | None = None, source: str = "source") -> DataFrame:
    """(source, n, rate). Without ``weights`` a source weighs its count to the power ``temperature``."""
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    counts = materialise(counts.withColumn("weight", weight), "sources")
    sums = counts.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    if not sums.w:
        return counts.select("source", "n", F.lit(0.0).alias("rate"))
    wanted = float(sums.n if total is None else total)
    found = counts.select("source", "n", (F.col("weight") / F.lit(float(sums.w)) * F.lit(wanted) / F.col("n")).alias("rate"))
    worst = 0.0 if weights is None else found.agg(F.max("rate")).first()[0]
    if worst > MOST_RATE:
        raise ValueError(f"a source would be repeated {worst:g} times; at most {MOST_RATE:g} is allowed")
    return found


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, total: float | None = None, seed: str = SEED, source: str = "source", key: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 1) and ``mix_key``, in the order of the mixture."""
    plain = docs.drop("copy", "mix_key")
    found = rates(plain, weights, temperature, total, source)
    table = materialise(found.select(F.col("source").alias("of"), cumulative(F.col("rate")).alias("cumulative"), first_listed(F.col("rate")).alias("_first")), "rates")
    # rows are carried as one struct, so no column of theirs meets a name that is used here
    packed = plain.select(F.struct(*(F.col(f"`{c}`") for c in plain.columns)).alias("row"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(source).alias("source"))
    counted = packed.join(table, F.col("source").eqNullSafe(F.col("of"))).withColumn("u", uniform(seed, F.col("id")))
    counted = counted.withColumn("times", F.col("_first") + F.size(F.filter("cumulative", lambda f: f < F.col("u")))).where("times > 0")
    copies = counted.select("row", "id", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    keyed = copies.withColumn("mix_key", F.md5(F.concat(F.lit(seed + ":"), "id", F.lit(":"), F.col("copy").cast("string"))))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key").select("row.*", "copy", "mix_key")


#: The same rows by SQL, with the production parameters.
MIX_SQL = f"""
WITH counts AS (SELECT source, count(*)::DOUBLE AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source),
rates AS (SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS rate FROM counts),
chances AS (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM rates, LATERAL (SELECT unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k)),
steps AS (SELECT source, list(f ORDER BY k) AS fs FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS f FROM chances) GROUP BY source),
counted AS (
  SELECT d.*, len(list_filter(s.fs, lambda f: f < (('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / {1 << 52}.0::DOUBLE)) AS times
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS mix_key
FROM counted, LATERAL (SELECT unnest(range(1, times + 1)) AS copy)
"""
