"""The page archive: a table of pages partitioned by association and shard, and readers of loose files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brandbook.functions import norm
from brandbook.session import workspace

SCHEMA = "reg string, suffix string, html string, association string, shard string"


def save(pages: DataFrame, path: str) -> None:
    """``pages(association, reg, suffix, html)`` added to the archive. The writer's committer makes a page
    visible as a whole; of a page saved twice the later batch counts in ``load``."""
    rows = pages.select("reg", "suffix", "html", F.current_timestamp().alias("saved_at"), F.upper("association").alias("association"), norm.shard(F.col("reg")).alias("shard"))
    rows.write.mode("append").partitionBy("association", "shard").option("compression", "zstd").parquet(path)


def scan(spark: SparkSession, path: str, association: str | None = None, suffixes: list[str] | None = None) -> DataFrame:
    """Pages of an association and of some tabs; only their partitions are read."""
    rows = spark.read.parquet(path)
    rows = rows if association is None else rows.where(F.col("association") == association.upper())
    return rows if suffixes is None else rows.where(F.col("suffix").isin(suffixes))


def latest(rows: DataFrame) -> DataFrame:
    """Each page as it was saved last."""
    values = [c for c in rows.columns if c not in ("association", "reg", "suffix")]
    last = rows.groupBy("association", "reg", "suffix").agg(F.max_by(F.struct(*values), "saved_at").alias("x"))
    return last.select("association", "reg", "suffix", "x.*")


def load(spark: SparkSession, path: str, association: str, reg: str, suffix: str) -> DataFrame:
    """One page, the latest that was saved; its shard names the only folder that is read."""
    shard = spark.range(1).select(norm.shard(F.lit(reg))).first()[0]
    rows = scan(spark, path, association, [suffix]).where((F.col("shard") == shard) & (F.col("reg") == reg))
    return rows.orderBy(F.desc("saved_at")).limit(1)


def missing(wanted: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Of ``wanted(association, reg, suffix)`` those that the archive doesn't have."""
    return wanted.join(scan(spark, path).select("association", "reg", "suffix"), ["association", "reg", "suffix"], "left_anti")


def read_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Loose files <ASSOC>_<reg>_<suffix>.html[.gz]: the association before the first, the suffix after the
    last underscore."""
    text = spark.read.option("wholetext", True).text(pattern).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("html"))
    part = lambda i: F.regexp_extract("name", r"^([^_]+)_(.+)_([^_]+?)\.html(\.gz)?$", i)
    return text.select(part(1).alias("association"), part(2).alias("reg"), part(3).alias("suffix"), "html").where("suffix <> ''")


def write_files(pages: DataFrame, name: str = "files") -> str:
    """The same as safe file names and shards, for a reader of files: (name, shard, html) as JSON; its path."""
    path = workspace(pages.sparkSession, name)
    token = F.concat_ws("_", *(norm.safe_token(F.col(c)) for c in ("association", "reg", "suffix")))
    pages.select(F.concat(token, F.lit(".html")).alias("name"), norm.shard(F.col("reg")).alias("shard"), "html").write.option("compression", "gzip").json(path)
    return path
