"""Reading and writing records, seeds, status files and dictionaries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brandbook.functions import extract
from brandbook.operators import progress
from brandbook.operators.ordered import numbered
from brandbook.schema import BREED_TOKENS, FRONTIER, PREFIXES, RECORD, STATUS, SUBDOMAINS
from brandbook.session import discard, materialise, publish, published


def read_records(spark: SparkSession, paths: str | list[str], array: bool = False) -> DataFrame:
    """JSONL (``array``: files of one JSON array or object) as records with ``seq``, the order of file name and
    place in it. Blank lines don't count, malformed ones are dropped.

    The order is what resolution depends on, so it is read off the file: lines are numbered by their place,
    not by whatever partition they were read in."""
    if array:
        text = spark.read.option("wholetext", True).text(paths).select(F.input_file_name().alias("file"), F.trim("value").alias("value"))
        whole = F.when(F.col("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
        items = F.from_json(whole, "array<string>")  # each item stays text, so one bad item doesn't take the rest
        lines = text.select("file", F.posexplode(items).alias("at", "value"))
    else:
        text = spark.read.text(paths)
        lines = text.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "value").where(F.trim("value") != "")
    return numbered(_valid(lines), ["file", "at"]).select("seq", "r.*").drop("_bad")


def _valid(lines: DataFrame) -> DataFrame:
    """(file, at, r) of the lines that hold a record."""
    parsed = lines.select("file", "at", F.from_json("value", f"{RECORD}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r is not null and r._bad is null and r.association is not null and r.regNumber is not null")


def _parsed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, at, r) of the records of JSONL files, files named as they are listed."""
    text = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.lit(None).cast("bigint").alias("at"), "value")
    return _valid(text.where(F.trim("value") != ""))


def malformed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, lines, bad) of JSONL files."""
    text = spark.read.text(paths).select(F.input_file_name().alias("file"), "value").where(F.trim("value") != "")
    bad = F.from_json("value", f"{RECORD}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return text.select("file", bad.alias("r")).groupBy("file").agg(F.count("*").alias("lines"), F.sum(F.when(F.col("r._bad").isNotNull() | F.col("r").isNull(), 1).otherwise(0)).alias("bad"))


def append_records(records: DataFrame, path: str) -> None:
    """JSONL files added to a folder."""
    records.drop("seq").write.mode("append").json(path)


def snapshot(df: DataFrame, path: str) -> None:
    """A small JSON table replaced as a whole: a new folder is written and then named, so readers by
    ``read_snapshot`` see the old or the new one. The folder before stays for readers that have begun."""
    spark, before = df.sparkSession, published(df.sparkSession, path)
    version = uuid.uuid4().hex
    df.write.json(f"{path}/{version}")
    publish(spark, path, version)
    for old in set(_versions(spark, path)) - {version, (before or "/").rsplit("/", 1)[1]}:
        discard(spark, f"{path}/{old}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table that ``snapshot`` wrote last; without one, no rows."""
    at = published(spark, path)
    return spark.createDataFrame([], schema) if at is None else spark.read.schema(schema).json(at)


def replace_board(board: DataFrame, path: str, schema: str, force: bool = False) -> bool:
    """``snapshot`` unless that would put an empty board in the place of one with readings; whether it did."""
    if not progress.may_replace(read_snapshot(board.sparkSession, path, schema), board, force):
        return False
    snapshot(board, path)
    return True


def loadable(records: DataFrame, *by: str) -> DataFrame:
    """(association, n): different registrations that a load without steers would write; with columns ``by``, for each of their values."""
    rows = records.where(F.upper(F.trim(F.coalesce("sex", F.lit("")))) != "S").select(*by, F.upper(F.trim("association")).alias("association"), F.upper(F.trim("regNumber")).alias("reg")).distinct()
    return rows.groupBy(*by, "association").agg(F.count("*").alias("n"))


MANIFEST = "file string, size bigint, changed timestamp, counts map<string,bigint>"


def counted(spark: SparkSession, paths: str | list[str], manifest: str) -> DataFrame:
    """(file, size, association, n) of JSONL files, n as ``loadable`` counts each file by itself. What a file held is kept in the snapshot
    ``manifest`` with its size and time; only files that are new or have changed are read, and files that are gone fall."""
    there = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))
    known = read_snapshot(spark, manifest, MANIFEST)
    seen = materialise(there.join(known, ["file", "size", "changed"], "left"), "files")
    fresh = [r.file for r in seen.where("counts is null").select("file").collect()]  # names, as Spark lists them on the driver too
    if not fresh and known.count() == seen.count():
        return seen.select("file", "size", F.explode("counts").alias("association", "n"))
    found = seen
    if fresh:
        per_file = loadable(_parsed(spark, fresh).select("file", "r.*"), "file")
        counts = per_file.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("association", "n"))).alias("new"))  # an entry an association
        found = seen.join(counts, "file", "left").withColumn("counts", F.coalesce("counts", "new", F.create_map().cast("map<string,bigint>"))).drop("new")
    found = materialise(found.select("file", "size", "changed", "counts"), "manifest")
    snapshot(found, manifest)
    return found.select("file", "size", F.explode("counts").alias("association", "n"))


def read_seeds(spark: SparkSession, path: str, association: str, priority: int = 0) -> DataFrame:
    lines = spark.read.text(path).select(extract.seeds(F.col("value"), F.lit(association)).alias("s")).where("s is not null")
    return lines.select("s.*", F.lit(priority).alias("priority"))


def enumerated(spark: SparkSession, association: str, start: int, end: int) -> DataFrame:
    """Seeds of a range of numbers, both ends included."""
    return spark.range(start, end + 1).select(F.lit(association.upper()).alias("association"), F.col("id").cast("string").alias("reg_number"), F.lit(0).alias("priority"))


def empty_frontier(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FRONTIER)


def migrated_frontier(old: DataFrame) -> DataFrame:
    """A frontier of an older layout with the columns it lacks."""
    defaults = {"priority": F.lit(0), "attempts": F.lit(0), "depth": F.lit(0), "status": F.lit("pending")}
    names = [(c.strip().split(" ")[0], c.strip().split(" ")[1]) for c in FRONTIER.split(",")]
    return old.select(*((F.col(n) if n in old.columns else defaults.get(n, F.lit(None))).cast(t).alias(n) for n, t in names))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Status files, one object each; unreadable ones are left out."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.from_json("value", f"{STATUS}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("s")).where("s._bad is null and s.association is not null").select("s.*").drop("_bad")


def statements(text: Column) -> Column:
    """The statements of a schema script: // comments go, ; ends one."""
    parts = F.split(F.regexp_replace(text, "//[^\n]*", ""), ";")
    return F.filter(F.transform(parts, lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != "")


def dim_association(spark: SparkSession) -> DataFrame:
    prefix = {a: p for p, a in reversed(PREFIXES.items())}
    return spark.createDataFrame([(c, s, prefix.get(c)) for c, s in SUBDOMAINS.items()] + [("ANGUS", None, prefix["ANGUS"])], "code string, subdomain string, prefix string")


def dim_breed_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in BREED_TOKENS], "token string")
