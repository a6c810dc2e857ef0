"""Quality by hierarchical empirical Bayes over documents, hosts and paths.

*Document evidence.* A logistic classifier over some two dozen shape statistics of the whole text, each cut
into bins at quantiles of the sample, fitted with numpy, in one task, on at most ``sample`` labelled ids (those with the
least hashes), of each id one text. It gives each document a probability p of being good.

*Sites.* For every host and every path of a host, the number of documents and the sum of p come from one
grouped sum (partial sums in each task, so a host with a third of all rows is one row a task). The global mean
is the prior of the hosts' means and a host's posterior mean the prior of its paths' means, each with a
strength (in documents) that the spread between sites gives by moments: sparse sites shrink to what stands
above them, large ones speak for themselves.

*Posterior.* A document's log-odds are those of its evidence, plus what its path's posterior (counted without
the document itself) differs from the global mean in log-odds. Documents at ``threshold`` or more are kept.

The table of paths is written before the documents join it: Spark broadcasts it if its size allows, else both
sides are shuffled and skewed paths split.

Edge cases: a null or empty text has all statistics zero and counts as any other; null hosts and paths are
sites of their own; ids without label aren't learned from, an id with labels of both kinds counts as bad, of several texts
of an id the one with the least hash is learned from;
without labels of both kinds every p is their mean (1 without any); repeated rows stay; an empty table gives
no rows; a text's length isn't limited; a column named like a result column is replaced.
"""

from __future__ import annotations

import re
from math import log1p
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.llm.arrow import carried, lean, one_text_each, slices, texts, uncarried, without_scan
from brandbook.session import materialise

SAMPLE = 20_000
BINS = 12
THRESHOLD = 0.5
LEAST_P = 0.001
RESULTS = ("p_doc", "p_host", "p_path", "posterior", "kept")
SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~=_@]")
DIGIT, UPPER = re.compile(r"\d"), re.compile(r"[^\W\d_a-zß-öø-ÿ]")
STOP = re.compile(r"[.!?…][\"')\]]*(?:\s|$)")


def statistics(text: str) -> list[float]:
    """The shape of a text."""
    words = text.split()
    n, lines = len(words), [x for x in text.split("\n") if x.strip()]
    if not n:
        return [0.0] * WIDTH
    chars, kinds, m = len(text), len(set(words)), len(lines)
    sizes = [len(w) for w in words]
    pairs = set(zip(words, words[1:]))
    symbols, digits, stops = len(SYMBOL.findall(text)), len(DIGIT.findall(text)), len(STOP.findall(text))
    ends = [x.rstrip()[-1] for x in lines]
    return [
        log1p(n), sum(sizes) / n, max(sizes) / 20, symbols / n, digits / n, stops / n, kinds / n, kinds / n**0.8, 1 - len(pairs) / max(1, n - 1), 1 - len(set(lines)) / m, log1p(m), n / m, max(map(len, lines)) / chars,
        sum(len(w) == 1 for w in words) / n, sum(s > 15 for s in sizes) / n, text.count("|") / n, text.count(",") / n, text.count("://") / n, sum(e in ".!?…" for e in ends) / m, sum(e in punctuation for e in ends) / m,
        len(UPPER.findall(text)) / chars, sum(w.isalpha() for w in words) / n, text.count("...") / m, (sum(s * s for s in sizes) / n - (sum(sizes) / n) ** 2) ** 0.5,
    ]


WIDTH = 24


@lean
def _statistics_pass(batches):
    for whole in batches:
        for batch in slices(whole, "scan"):
            rows = [statistics((v or b"").decode("utf-8", "replace")) for v in texts(batch, "scan")]
            keep = without_scan(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "stats"])


def design(stats: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The bin of every statistic, as a column number of a one-hot matrix."""
    return np.stack([np.searchsorted(cuts[:, j], stats[:, j], "left") + j * (BINS + 1) for j in range(stats.shape[1])], axis=1)


def fit(stats: np.ndarray, good: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 2e-4) -> dict:
    """Cuts and the weight of each bin, by Adam on the logistic loss."""
    cuts = np.quantile(stats, np.arange(1, BINS + 1) / (BINS + 1), axis=0)
    rows, width = design(stats, cuts), stats.shape[1] * (BINS + 1)
    base = np.log(good.mean() / (1 - good.mean()))
    w, m, v = (np.zeros(width) for _ in range(3))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(base + w[rows].sum(axis=1), -30, 30)))
        slope = np.bincount(rows.ravel(), weights=np.repeat(p - good, rows.shape[1]), minlength=width) / len(good) + decay * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"cuts": cuts, "weights": w, "base": float(base)}


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> dict:
    """A classifier, or the labels' mean where there is only one kind."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("good")).where("id is not null and good is not null")
    mean = known.agg(F.avg("good")).first()[0]
    if mean is None or not 0 < mean < 1:
        return {"mean": 1.0 if mean is None else float(mean)}
    once = known.groupBy("id").agg(F.min("good").alias("good"))
    # one row an id, so bounded by ``sample`` at any size of the corpus
    chosen = materialise(once.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(sample), "labelled")
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    stats = one_text_each(rows, chosen, "h", "good").withColumnRenamed("text", "scan").mapInArrow(_statistics_pass, "h bigint, good int, stats array<double>")
    found = stats.repartition(1).mapInArrow(_fit_pass, "cuts array<array<double>>, weights array<double>, base double").first()
    if found is None:
        return {"mean": float(mean)}
    return {"cuts": np.array(found.cuts), "weights": np.array(found.weights), "base": found.base}


@lean
def _fit_pass(batches):
    """``fit`` over the labelled rows, at most ``sample``, in one task; nothing where they are of one kind."""
    batches = list(batches)
    got = pa.Table.from_batches(batches) if batches else None
    if got is None or len(set(got["good"].to_pylist())) < 2:
        return
    good = got["good"].to_numpy().astype(float)
    stats = np.round(np.stack(got["stats"].to_numpy()), 9)
    order = np.lexsort((*stats.T, good, got["h"].to_numpy()))
    found = fit(stats[order], good[order])
    columns = [pa.array([found["cuts"].tolist()], pa.list_(pa.list_(pa.float64()))), pa.array([found["weights"].tolist()], pa.list_(pa.float64())), pa.array([found["base"]])]
    yield pa.RecordBatch.from_arrays(columns, names=["cuts", "weights", "base"])


def _evidence_pass(shared, path: str):
    @lean
    def run(batches):
        model = shared.value
        for whole in batches:
            for batch in slices(whole, path):
                if "mean" in model:
                    p = np.full(batch.num_rows, model["mean"])
                else:
                    stats = np.round(np.array([statistics((v or b"").decode("utf-8", "replace")) for v in texts(batch, path)]), 9)
                    p = 1 / (1 + np.exp(-np.clip(model["base"] + model["weights"][design(stats, model["cuts"])].sum(axis=1), -30, 30)))
                p = np.round(np.clip(p, LEAST_P, 1 - LEAST_P), 6)
                keep = without_scan(batch)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(p)], names=[*keep, "p_doc"])

    return run


def evidence(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None, *more: Column) -> DataFrame:
    """The columns ``keep`` (all by default) as one struct ``row``, ``more`` columns, and p_doc."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    rows, path = carried(docs, kept, text, *more)
    schema = rows.drop("scan").schema.add("p_doc", "double")
    return rows.mapInArrow(_evidence_pass(docs.sparkSession.sparkContext.broadcast(model), path), schema)


def _strength(groups: DataFrame, mean: Column, above: Column) -> float:
    """How many documents the mean above is worth: m(1 - m) over the variance between sites, less 1."""
    n, size = F.sum("n"), F.count("*")
    within = F.sum(mean * (1 - mean))
    row = groups.agg(n.alias("n"), size.alias("k"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(F.col("n") * (mean - above) ** 2).alias("between"), (within / size).alias("within"), F.avg(above * (1 - above)).alias("m")).first()
    if not row.n or row.k < 2:
        return 1.0
    # of the weighted squares between sites, each site's own noise is expected to give ``within``
    variance = max(0.0, (row.between - row.k * row.within) / max(1e-9, row.n - row.n2 / row.n))
    return float(round(min(1e4, max(1.0, row.m / variance - 1 if variance > 1e-9 else 1e4)), 6))


def sites(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, dict]:
    """The table (host, path, n, s, host_n, host_s) and the prior: mean and the strengths of hosts and paths."""
    paths = materialise(scored.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path")).agg(F.count("*").alias("n"), F.sum(F.col("p_doc").cast("decimal(20,6)")).cast("double").alias("s")), "paths")
    hosts = materialise(paths.groupBy(F.col("_host").alias("_h")).agg(F.sum("n").alias("host_n"), F.sum(F.col("s").cast("decimal(20,6)")).cast("double").alias("host_s")), "hosts")
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum(F.col("host_s").cast("decimal(20,6)")).cast("double").alias("s")).first()
    mean = total.s / total.n if total.n else 0.5
    host_strength = _strength(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s")), F.col("s") / F.col("n"), F.lit(mean))
    both = materialise(paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h"), "sites")
    path_strength = _strength(both, F.col("s") / F.col("n"), (F.col("host_s") + host_strength * mean) / (F.col("host_n") + host_strength))
    return both, {"mean": mean, "host": host_strength, "path": path_strength}


def posterior(scored: DataFrame, table: DataFrame, prior: dict, host: str, path: str, threshold: float = THRESHOLD) -> DataFrame:
    """``scored`` with p_host, p_path, posterior and kept."""
    mean = min(1 - LEAST_P, max(LEAST_P, prior["mean"]))
    odds = lambda p: F.log(p / (1 - p))
    table = table.select("_host", "_path", *(F.col(c).alias(f"_{c}") for c in ("n", "s", "host_n", "host_s")))
    joined = scored.join(table, F.col(f"`{host}`").eqNullSafe(F.col("_host")) & F.col(f"`{path}`").eqNullSafe(F.col("_path")))
    p_host = (F.col("_host_s") - F.col("p_doc") + prior["host"] * mean) / (F.col("_host_n") - 1 + prior["host"])
    p_path = (F.col("_s") - F.col("p_doc") + prior["path"] * F.col("p_host")) / (F.col("_n") - 1 + prior["path"])
    joined = joined.withColumn("p_host", F.round(F.least(F.lit(1 - LEAST_P), F.greatest(F.lit(LEAST_P), p_host)), 6))
    joined = joined.withColumn("p_path", F.round(F.least(F.lit(1 - LEAST_P), F.greatest(F.lit(LEAST_P), p_path)), 6))
    both = odds(F.col("p_doc")) + odds(F.col("p_path")) - F.lit(float(np.log(mean / (1 - mean))))
    joined = joined.withColumn("posterior", F.round(1 / (1 + F.exp(-both)), 6)).withColumn("kept", F.col("posterior") >= threshold)
    return joined.drop("_host", "_path", "_n", "_s", "_host_n", "_host_s")


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", text: str = "text", key: str = "doc_id", keep: list[str] | None = None, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` with p_doc, p_host, p_path, posterior and kept.

    Two passes over the texts: one for the sites' sums, one for the rows themselves, so that texts aren't
    shuffled; where ``keep`` is given, its rows are written once and the second pass reads those."""
    model = train(docs, labels, text, key, sample)
    place = [F.col(host).alias("_site"), F.col(path).alias("_page")]
    scored = materialise(evidence(docs, model, text, [] if keep is None else keep, *place), "evidence")
    table, prior = sites(scored, "_site", "_page")
    if keep is None:
        scored = evidence(docs, model, text, None, *place)
    return uncarried(posterior(scored, table, prior, "_site", "_page", threshold), *RESULTS)
