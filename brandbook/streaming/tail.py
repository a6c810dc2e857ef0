"""A stream of the lines that growing JSONL files gain, and the load that follows it.

Spark's file source takes each file once; these files are appended to. The offset is a byte position per file;
a batch takes whole lines only, and starts over where a file has shrunk. Byte ranges are read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from brandbook.operators.block_index import BlockIndex
from brandbook.operators.ordered import numbered
from brandbook.schema import RECORD
from brandbook.session import discard, publish, published, scratch

#: Bytes of a file that a task reads.
PART_BYTES = 16 << 20
READ_BYTES, LOOK_BYTES = 1 << 20, 1 << 16


def _opened(path: str):
    """The file system of a path and the path in it: local, or any that Arrow opens by its scheme (HDFS, S3, GCS, Azure)."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def sizes(paths: list[str]) -> dict[str, int]:
    """The bytes of the files that are there."""
    found = {}
    for path in paths:
        system, name = _opened(path)
        info = system.get_file_info(name)
        if info.type == pafs.FileType.File:
            found[path] = info.size
    return found


def whole_until(path: str, size: int) -> int:
    """Where the last whole line of the first ``size`` bytes ends; reads a few kilobytes about that place."""
    system, name = _opened(path)
    with system.open_input_file(name) as file:
        while size > 0:
            low = max(0, size - LOOK_BYTES)
            if (at := file.read_at(size - low, low).rfind(b"\n")) >= 0:
                return low + at + 1
            size = low
    return 0


def lines_between(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that begin in ``start`` up to ``stop``, but for blank ones. ``start`` needn't be the beginning
    of a line; the last line is read to its end, beyond ``stop``."""
    system, name = _opened(path)
    with system.open_input_file(name) as file:
        at, rest = start, b""
        if start:  # what begins at start has a line end before it
            file.seek(start - 1)
            while True:
                chunk = file.read(READ_BYTES)
                if not chunk:
                    return
                if (end := chunk.find(b"\n")) >= 0:
                    at, rest = at - 1 + end + 1, chunk[end + 1 :]
                    break
                at += len(chunk)
        while at < stop:
            chunk = file.read(READ_BYTES)
            *lines, rest = (rest + chunk).split(b"\n")
            for line in lines:
                if at >= stop:
                    return
                if line.strip():
                    yield at, line
                at += len(line) + 1
            if not chunk:
                return


@dataclass
class Part(InputPartition):
    path: str
    start: int
    stop: int


class TailReader(DataSourceStreamReader):
    """Offsets are a byte per file, always the end of a line. The driver looks at sizes and a few kilobytes; lines are read by
    the tasks, a range of ``partbytes`` each, so a batch of any size is spread and needs no cap. An end before the start
    means that the file has shrunk: it is read from its first byte."""

    def __init__(self, options):
        self.paths = [p for p in options["path"].split(",") if p]
        self.part = int(options.get("partbytes", PART_BYTES))
        self.at: dict = {}

    def initialOffset(self) -> dict:
        return {p: 0 for p in self.paths}

    def latestOffset(self) -> dict:
        """As far as whole lines go. A file that isn't there stays where this reader saw it last."""
        found = sizes(self.paths)
        return {p: whole_until(p, found[p]) if p in found else self.at.get(p, 0) for p in self.paths}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self.at = dict(end)
        parts = []
        for path in self.paths:
            stop = end.get(path, 0)
            first = start.get(path, 0) if start.get(path, 0) <= stop else 0
            parts += [Part(path, at, min(at + self.part, stop)) for at in range(first, stop, self.part)]
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        found, size = [], 0

        def made() -> pa.RecordBatch:
            at, lines = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(at)), pa.array(at, pa.int64()), pa.array([x.decode("utf-8", "replace") for x in lines])], names=["file", "at", "value"])

        for at, line in lines_between(partition.path, partition.start, partition.stop):
            found.append((at, line))
            size += len(line)
            if size >= READ_BYTES:
                yield made()
                found, size = [], 0
        if found:
            yield made()

    def commit(self, end: dict) -> None:
        self.at = dict(end)


class TailSource(DataSource):
    """``spark.readStream.format("tail").option("path", "a.jsonl,b.jsonl")``: file, at, value."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "file string, at bigint, value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def records_of(lines: DataFrame) -> DataFrame:
    """Records among ``lines(file, at, value)``; malformed ones are dropped."""
    parsed = lines.select("file", "at", F.from_json("value", f"{RECORD}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r is not null and r._bad is null and r.association is not null and r.regNumber is not null").select("file", "at", "r.*").drop("_bad")


def follow(spark: SparkSession, paths: list[str], sink, checkpoint: str, once: bool = False, every: str = "60 seconds", part_bytes: int = PART_BYTES, name: str | None = None):
    """Start a query that hands each batch of records to ``sink(records, batch_id)``. Offsets advance after the
    sink, so a batch may come again and the sink must be an upsert (``store`` is). With ``once`` the files are read
    to their ends before this returns: a run asks for the latest offset only once, so runs follow one another until
    one makes no batch."""
    spark.dataSource.register(TailSource)
    lines = spark.readStream.format("tail").option("path", ",".join(paths)).option("partbytes", part_bytes).load()
    writer = records_of(lines).writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.queryName(name) if name else writer
    if not once:
        return writer.trigger(processingTime=every).start()
    while True:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        if not any(p["sources"][0]["startOffset"] != p["sources"][0]["endOffset"] for p in query.recentProgress):
            return query


def store(path: str):
    """A sink that keeps all records, one folder per batch, written over if the batch comes again."""

    def sink(records: DataFrame, batch_id: int) -> None:
        records.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sink


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All records that ``store`` holds, with ``seq`` in the order in which they came."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return numbered(rows.drop("batch_id"), ["batch", "file", "at"]).drop("batch", "file", "at")


def load_graph(graph_path: str, epoch: str = "e0", visible: bool = True, **options):
    """A sink that brings the graph in ``graph_path`` up to date with each batch. Blocks are kept between batches
    (``operators.block_index``), so a batch costs what it touches, not what is stored. Its tables are written first and then
    named, so readers (``Herd.current``) see the graph before or after a batch; one that comes again gives the same graph.
    Without ``visible`` nothing is named: a shadow that ``rebuild`` names when it is whole."""

    def sink(records: DataFrame, batch_id: int) -> None:
        spark, name = records.sparkSession, f"{graph_path}/{epoch}/v-{batch_id}"
        if visible and published(spark, graph_path) == name:
            return
        with scratch(spark):
            BlockIndex(spark, f"{graph_path}/{epoch}").add(records, batch_id, ["file", "at"], **options)
        if visible:
            publish(spark, graph_path, name.removeprefix(f"{graph_path}/"))

    return sink


def loaded(spark: SparkSession, graph_path: str) -> tuple[BlockIndex, int] | None:
    """The index and the batch that readers of ``graph_path`` see."""
    at = published(spark, graph_path)
    if at is None:
        return None
    folder, version = at.rsplit("/", 1)
    return BlockIndex(spark, folder), int(version.removeprefix("v-"))


def compact(spark: SparkSession, graph_path: str) -> None:
    """Write what readers see into an epoch of its own and name it. The query that loads must stand still, and goes on with the new epoch."""
    index, batch = loaded(spark, graph_path)
    epoch = f"e{uuid.uuid4().hex[:8]}"
    with scratch(spark):
        index.compacted(f"{graph_path}/{epoch}", batch)
    publish(spark, graph_path, f"{epoch}/v-{batch}")


def current_epoch(spark: SparkSession, graph_path: str) -> str:
    at = published(spark, graph_path)
    return "e0" if at is None else at.rsplit("/", 2)[1]


def rebuild(spark: SparkSession, paths: list[str], graph_path: str, part_bytes: int = PART_BYTES, **options) -> str:
    """Load files from their first byte into a shadow with a checkpoint of its own, and name it once it has all that the files
    held; readers keep the old graph until then. A rebuild that was killed goes on where it was: the shadow's name is
    kept in ``graph_path`` until it is named. Gives the epoch; a following load goes on with it and its checkpoint."""
    marks = f"{graph_path}/_rebuild"
    begun = published(spark, marks)
    epoch = begun.rsplit("/", 1)[1] if begun else f"e{uuid.uuid4().hex[:8]}"
    if not begun:
        publish(spark, marks, epoch)
    folder = f"{graph_path}/{epoch}"
    query = follow(spark, paths, load_graph(graph_path, epoch, visible=False, **options), f"{folder}/_checkpoint", once=True, part_bytes=part_bytes)
    query.awaitTermination()
    last = BlockIndex(spark, folder).last()
    if last is not None:
        publish(spark, graph_path, f"{epoch}/v-{last}")
    discard(spark, marks)
    return epoch
