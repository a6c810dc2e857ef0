"""Quality rules as a decision list learned by sequential covering. DataFrame functions only.

*Statistics.* ``statistics`` works out the counts of a text inside its own row with array functions, so its words and
their windows are arrays of one row (some fifty bytes a word): repeated windows of three words are found by sorting the windows' 64-bit hashes with their
positions, so a row costs n log n and no occurrence is shuffled.

*Learning.* Rows with labels are cut into bins of exact quantiles and split by a hash into a growing and a
pruning part. A rule that rejects starts empty and takes, one at a time, the threshold condition with the
greatest FOIL gain over the rows that no earlier rule covers; every step needs one grouped count per feature
and bin. It is then pruned to the prefix with the best (p - n) / (p + n) on the pruning part. Rules are added
until one would be wrong too often (``precision``) or catch too little (``support``). Only those small grouped
counts reach the driver. The sample is bounded: the ``sample`` labelled rows with the least hashes.

*Result.* Ordered conditions, the first that holds rejects, as one Spark expression.

Edge cases: a null or empty text has no words; a null label or an id without label isn't learned from;
several labels of an id are rows of their own; without labels of both kinds no rule is learned and all rows
are kept; repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brandbook.session import materialise

SPACE = "[ \\t-\\r]"
SAMPLE = 50_000
BINS = 32
BASE_WORDS = 50


def let(value: Column, body) -> Column:
    """``body(value)``, the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """How many words are in windows of three that occur twice or more."""
    hashes = F.transform(F.slice(words, 1, n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twins = lambda s: F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        starts = F.sort_array(F.transform(let(placed, lambda s: twins(s)), lambda x: x["i"]))
        covered = lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(starts, covered))

    return F.when(n < 4, F.lit(0)).otherwise(let(hashes, count))


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of whole texts."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = F.split("text", f"{SPACE}+")
    # a text that begins or ends with white space gives an empty first or last piece
    words = let(cut, lambda c: F.slice(c, F.when(F.get(c, F.lit(0)) == "", 2).otherwise(1), F.greatest(F.lit(0), F.size(c) - F.when(F.get(c, F.lit(0)) == "", 1).otherwise(0) - F.when((F.size(c) > 1) & (F.element_at(c, -1) == ""), 1).otherwise(0))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    rows = rows.select(
        "doc_id", words.alias("words"), lines.alias("lines"), F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).alias("n_symbols"),
    )
    n = F.size("words")
    return rows.select(
        "doc_id", n.cast("bigint").alias("n_words"), F.length(F.concat_ws("", "words")).cast("bigint").alias("word_chars"), F.col("n_symbols").cast("bigint"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), _repeat_words(F.col("words"), n).cast("bigint").alias("n_repeat_words"), F.size("lines").cast("bigint").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """The numbers that conditions are about; no words: 0."""
    per = lambda c, of: F.when(F.col(of) > 0, F.round(F.col(c) / F.col(of), 4)).otherwise(F.lit(0.0))
    return {
        "words": F.col("n_words").cast("double"), "word_length": per("word_chars", "n_words"), "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"), "repeat_share": per("n_repeat_words", "n_words"), "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # else at or below
    value: float

    def expression(self) -> Column:
        x = features()[self.feature]
        return x > self.value if self.above else x <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:g}"


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of ``cuts`` are below ``value``."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))


def _holds(rule: list[tuple[str, bool, int]]) -> Column:
    """A conjunction over the bin columns."""
    out = F.lit(True)
    for feature, above, at in rule:
        out = out & (F.col(f"b_{feature}") > at if above else F.col(f"b_{feature}") <= at)
    return out


def _best_condition(rows: DataFrame, names: list[str]) -> tuple[tuple[str, bool, int], float] | None:
    """The threshold with the greatest FOIL gain over ``rows(bad, b_*)``."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in names)))
    counts = rows.select("bad", pairs.alias("x")).groupBy("x.f", "x.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    by: dict[str, list] = {f: sorted((r.b, r.p, r.n) for r in counts if r.f == f) for f in names}
    p0, n0 = (sum(x[i] for x in by[names[0]]) for i in (1, 2))
    if not p0:
        return None
    best = None
    for f in names:
        p = n = 0
        for b, dp, dn in by[f][:-1]:
            p, n = p + dp, n + dn
            for above, pos, neg in ((False, p, n), (True, p0 - p, n0 - n)):
                if pos:
                    gain = pos * (math.log2(pos / (pos + neg)) - math.log2(p0 / (p0 + n0)))
                    if best is None or gain > best[1] + 1e-9:
                        best = ((f, above, b), gain)
    return best


def _centred(rows: DataFrame, rules: list[list[tuple[str, bool, int]]]) -> list[list[Condition]]:
    """The rules with each threshold in the middle of the gap that it lies in, so that neither side of the
    sample touches it."""
    used = sorted({(f, at) for rule in rules for f, _, at in rule})
    if not used:
        return []
    ends = [x for f, at in used for x in (F.max(F.when(F.col(f"b_{f}") <= at, F.col(f))).alias(f"low_{f}_{at}"), F.min(F.when(F.col(f"b_{f}") > at, F.col(f))).alias(f"high_{f}_{at}"))]
    seen = rows.agg(*ends).first()
    middle = {(f, at): (seen[f"low_{f}_{at}"] + seen[f"high_{f}_{at}"]) / 2 for f, at in used}
    return [[Condition(f, above, middle[f, at]) for f, above, at in rule] for rule in rules]


def learn(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_rules: int = 8, most_conditions: int = 4, precision: float = 0.9, support: float = 0.01) -> list[list[Condition]]:
    """Rules that reject, in order, from ``labels(doc_id, quality)``: quality 0 is bad."""
    good = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("quality")).where("quality is not null and id is not null")
    known = stats.where(~base_failed()).join(good, F.col("doc_id") == F.col("id"))
    wanted = known.select((1 - F.col("quality").cast("bigint")).alias("bad"), F.xxhash64("doc_id").alias("h"), *(c.alias(f) for f, c in features().items()))
    rows = materialise(wanted.orderBy("h", *features()).limit(sample), "labelled")
    names = [*features()]
    at = [i / BINS for i in range(1, BINS)]
    # quantiles of the bad rows and of all: either kind may be rare
    wide = rows.agg(*(F.percentile(f, at).alias(f"all_{f}") for f in names), *(F.percentile(F.when(F.col("bad") == 1, F.col(f)), at).alias(f"bad_{f}") for f in names)).first()
    cuts = {f: sorted({*(wide[f"all_{f}"] or ()), *(wide[f"bad_{f}"] or ())}) for f in names}
    names = [f for f in names if cuts[f]]
    if not names:
        return []
    bins = [_bin(F.col(f), cuts[f]).alias(f"b_{f}") for f in names]
    rows = materialise(rows.select("bad", (F.pmod(F.shiftright("h", 7), F.lit(3)) == 0).alias("pruning"), *names, *bins), "binned")
    bad = rows.agg(F.sum("bad").alias("bad")).first().bad or 0
    rules: list[list[tuple[str, bool, int]]] = []
    open_rows = F.lit(True)
    while len(rules) < most_rules:
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < most_conditions:
            found = _best_condition(rows.where(~F.col("pruning") & open_rows & _holds(rule)), names)
            if not found or found[1] <= 0:
                break
            rule.append(found[0])
        if not rule:
            break
        tests = [F.sum(F.when(_holds(rule[:k]), v).otherwise(0)).alias(f"{c}{k}") for k in range(1, len(rule) + 1) for c, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
        seen = rows.where(F.col("pruning") & open_rows).agg(*tests).first()
        value = {k: ((seen[f"p{k}"] or 0) - (seen[f"n{k}"] or 0)) / max(1, (seen[f"p{k}"] or 0) + (seen[f"n{k}"] or 0)) for k in range(1, len(rule) + 1)}
        keep = max(value, key=lambda k: (round(value[k], 12), seen[f"p{k}"] or 0, -k))
        p, n = seen[f"p{keep}"] or 0, seen[f"n{keep}"] or 0
        if p < max(1, support * bad / 3) or p < precision * (p + n):
            break
        rules.append(rule[:keep])
        open_rows = open_rows & ~_holds(rule[:keep])
    return _centred(rows, rules)


def rejects(rules: list[list[Condition]]) -> Column:
    """The number, from 1, of the first rule that rejects a row of statistics; else null."""
    out = None
    for number, rule in enumerate(rules, 1):
        condition = F.lit(True)
        for c in rule:
            condition = condition & c.expression()
        out = F.when(condition, number) if out is None else out.when(condition, number)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The statistics of every row with base_failed, rule (the number of the rule that rejects it) and kept."""
    stats = materialise(statistics(docs, text, key), "statistics")
    rules = learn(stats, labels, **options)
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", rejects(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
