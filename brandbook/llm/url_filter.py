"""URL filter: rules first, then the ratio of two character language models. DataFrame functions only.

*Rules.* (verdict, host, path) rules fit a host and its subdomains if the URL's path starts with the rule's
path; the longest rule wins, of equally long ones that with the longer host.

*Models.* URLs that a rule allows or blocks are the accepted and the rejected sample. For either, a
variable-order Markov model over the characters of host and path (start and end marked) gives each character
the Witten-Bell interpolation of all context lengths from 0 to ``order``: a context seen n times with t
different followers weighs n / (n + t) against the next shorter one, down to a uniform guess.

*Score.* The log-likelihood difference of the models over a URL, divided by its characters and the end mark,
is compared with a threshold that lies as many standard deviations below the accepted sample's mean as above
the rejected sample's. Differences are kept as whole millionths, so sums don't depend on their order.

Every position of every URL is counted once, as the longest gram that ends there; shorter contexts are sums
over those grams, and probabilities are worked out once for each different gram. The different URLs are dealt to all
tasks before their positions are listed. Positions meet the gram table where they are, by broadcast, if its measured
bytes allow, else in one equi-join that adaptive execution can split where a gram (such as ``http`` hosts have) is
very frequent; counts are summed in each task before they are shuffled.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule, and is scored as an
empty string; without rows of either sample that model is uniform and the threshold 0; repeated rows count
and come out as often as they are there; a url's length isn't limited, but its positions are one row's array; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brandbook.llm.joins import bounded
from brandbook.session import materialise

ORDER = 4
SCALE = 1_000_000
START, STOP = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the production list.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", key: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict), the verdict null where no rule fits."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": rule, "verdict": verdict})


def _grams(text: Column, order: int) -> Column:
    """The (order + 1)-grams that end at each character of ``text`` and at the end mark."""
    marked = F.concat(F.lit(START * order), text, F.lit(STOP))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substr(marked, i, F.lit(order + 1)))


def _dealt(urls: DataFrame) -> DataFrame:
    """A small table in as many parts as a shuffle has: each of its rows becomes many."""
    return urls.repartition(int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text")


def gram_ratios(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls(text, verdict, copies)`` to ``(gram, ratio)``: the log of the accepted over the rejected model's
    probability of the gram's last character after the others, in millionths."""
    counts = _dealt(urls).select(F.explode(_grams(F.col("text"), order)).alias("gram"), "copies", "verdict").groupBy("gram").agg(
        *(F.sum(F.when(F.col("verdict") == v, F.col("copies")).otherwise(0)).alias(f"{c}{order}") for v, c in (("allow", "a"), ("block", "r")))
    )
    counts = materialise(counts, "grams")
    symbols = counts.agg(F.countDistinct(F.substring("gram", -1, 1)).alias("symbols"))
    level = None
    for j in range(order + 1):
        known = counts.groupBy(F.substring("gram", -(j + 1), j + 1).alias("g")).agg(F.sum(f"a{order}").alias("a"), F.sum(f"r{order}").alias("r"))
        context = Window.partitionBy(F.substring("g", 1, j))
        sums = [F.sum(c).over(context).alias(f"n{c}") for c in "ar"] + [F.sum((F.col(c) > 0).cast("bigint")).over(context).alias(f"t{c}") for c in "ar"]
        known = known.select("g", "a", "r", *sums)
        if level is None:
            known = known.crossJoin(F.broadcast(symbols)).withColumns({"qa": 1.0 / F.col("symbols"), "qr": 1.0 / F.col("symbols")})  # symbols is one row
        else:
            shorter = level.select(F.col("g").alias("s"), F.col("pa").alias("qa"), F.col("pr").alias("qr"))
            known = known.join(shorter, F.substring("g", 2, j) == F.col("s"))
        mixed = {f"p{c}": F.when(F.col(f"n{c}") == 0, F.col(f"q{c}")).otherwise((F.col(c) + F.col(f"t{c}") * F.col(f"q{c}")) / (F.col(f"n{c}") + F.col(f"t{c}"))) for c in "ar"}
        level = known.withColumns(mixed).select("g", "pa", "pr")
    ratio = F.round((F.log("pa") - F.log("pr")) * SCALE).cast("bigint")
    return materialise(level.select(F.col("g").alias("gram"), ratio.alias("ratio")), "ratios")


def scores(urls: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """``(text, score)``: the mean ratio over each different text's positions, in millionths."""
    places = _dealt(urls).select("text", F.explode(_grams(F.col("text"), order)).alias("gram"))
    return places.join(bounded(ratios), "gram").groupBy("text").agg((F.sum("ratio") / F.count("*")).alias("score"))


def threshold(scored: DataFrame) -> float:
    """``scored(score, verdict, copies)`` to the score at which either sample is equally many deviations off."""
    n, s = F.sum("copies"), F.sum(F.col("copies") * F.col("score"))
    square = F.sum(F.col("copies") * F.col("score") * F.col("score"))
    rows = {r.verdict: r for r in scored.where("verdict is not null").groupBy("verdict").agg((s / n).alias("mean"), (square / n).alias("square")).collect()}
    if set(rows) != {"allow", "block"}:
        return 0.0
    (ma, da), (mr, dr) = ((rows[v].mean, max(0.0, rows[v].square - rows[v].mean ** 2) ** 0.5) for v in ("allow", "block"))
    return round((ma * dr + mr * da) / (da + dr) if da + dr else (ma + mr) / 2, 3)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, order: int = ORDER, url: str = "url", key: str = "page_id") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict and the model's score in millionths."""
    rows = materialise(parsed(pages, RULES if rules is None else rules, url, key), "urls")
    text = F.concat("host", "path")
    urls = materialise(rows.groupBy(text.alias("text"), "verdict").agg(F.count("*").alias("copies")), "texts")
    scored = materialise(scores(urls, gram_ratios(urls, order), order), "scores")
    cut = threshold(urls.where("verdict is not null").join(scored, "text"))
    own = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return rows.withColumn("text", text).join(scored, "text").select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score")
