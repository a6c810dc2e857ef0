"""Session helpers: table access, the shared folder, and lineage cuts that survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Paths that this process has handed out and not deleted.
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir`` (or by ``setCheckpointDir``). Only where neither is
    set and all runs in one process, as in tests, a temporary folder is made and registered for the session.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="brandbook-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; no two calls return the same one."""
    _made.append(f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def materialise(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage like ``checkpoint()`` (every executor can read the files again after a loss) but
    stays columnar and gives the planner true sizes, so that small tables are broadcast by measured size
    and large ones are not.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as a shuffle has partitions, for rows from which much more is made: a
    small file is read by a task or two, and all that follows would be theirs. The number is given, since adaptive
    execution would bring rows of few bytes together again."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of the shared folder, or any that Spark can open, is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Put one file in another's place, in one step where the file system can."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), conf).rename(path(source), path(target), how)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file hold ``text``; readers see what it held before or this, never a part."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    aside = jvm.org.apache.hadoop.fs.Path(f"{folder}/_next-{name}-{uuid.uuid4().hex}")
    out = aside.getFileSystem(conf).create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _rename_over(spark, aside.toString(), path)


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make ``path``/``version`` what ``published`` says; readers see the version before or this one, never a part."""
    replace_text(spark, f"{path}/_current", version)


def published(spark: SparkSession, path: str) -> str | None:
    """The folder that ``publish`` named last, or None."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return f"{path}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def tidied(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query(spark, ...)``, whose intermediate tables are deleted but for those that its result reads."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        with scratch(spark) as keep:
            return keep(query(spark, *args, **options))

    return run


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Within it, intermediate tables are made as ever; at its end they are deleted, but for those of frames
    that were handed to the function it gives. What is still lazy by then must not read deleted ones."""
    start, kept = len(_made), set()

    def keep(df: DataFrame) -> DataFrame:
        for folder in {name.rsplit("/", 1)[0].removeprefix("file:").lstrip("/") for name in df.inputFiles()}:
            parts = folder.split("/")
            kept.update("/".join(parts[:n]) for n in range(1, len(parts) + 1))  # a table may be partitioned
        return df

    try:
        yield keep
    finally:
        for path in _made[start:]:
            if path.removeprefix("file:").lstrip("/") not in kept:
                discard(spark, path)
                _made.remove(path)
