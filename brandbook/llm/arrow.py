"""Running a per-row function over Arrow batches, with bounded batches in and out."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from brandbook.session import materialise

#: Bytes of input that are turned into Python objects at a time.
SLICE_BYTES = 4 << 20


def lean(run):
    """``run``, a function of a task's batches, that gives memory back to the system at its end. Python workers stay for later
    tasks, and what they had needed for one stage would add to what the next one needs."""

    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
                trim(0)

    return whole


def field(batch: pa.RecordBatch, path: str) -> pa.Array:
    """A text column, or a dotted field of a struct column, as bytes. Strings aren't copied for that."""
    name, *inner = path.split(".")
    column = batch.column(name)
    for part in inner:
        column = pc.struct_field(column, part)
    return column.cast(pa.binary())


def slices(batch: pa.RecordBatch, path: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of the text at ``path`` each, one row at least."""
    lengths = pc.binary_length(field(batch, path)).fill_null(0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, path: str) -> list[bytes | None]:
    return field(batch, path).to_pylist()


def carried(docs: DataFrame, kept: list[str], text: str, *more: Column) -> tuple[DataFrame, str]:
    """The columns ``kept`` of ``docs`` as one struct ``row``, so that no name of theirs meets one used on the way,
    with ``more``, and the path at which a task finds the text: in the struct if it is kept (a dotted path into a
    struct column too), else in a column ``scan``. ``uncarried`` takes the struct apart again."""
    row = [F.struct(*(F.col(f"`{c}`").alias(c) for c in kept)).alias("row")] if kept else []
    if text.split(".")[0] in kept:
        return docs.select(*row, *more), f"row.{text}"
    return docs.select(*row, *more, F.col(text).cast("binary").alias("scan")), "scan"


def one_text_each(rows: DataFrame, chosen: DataFrame, *named: str) -> DataFrame:
    """(``named``, text) of ``rows(id, text)`` whose id is in ``chosen(id, ...)``, a table small enough to broadcast: one row for each row
    of it, of the texts of a repeated id the one with the least hash. Only repeated ids are shuffled, at most one text an id and task."""
    counts = rows.select("id").join(F.broadcast(chosen.select("id").distinct()), "id").groupBy("id").agg(F.count("*").alias("n"))
    again = F.broadcast(materialise(counts.where("n > 1").select("id"), "repeated"))  # no more rows than ``chosen``
    single = rows.join(again, "id", "left_anti")
    least = rows.join(again, "id").groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return single.unionByName(least).join(F.broadcast(chosen), "id").select(*named, "text")


def without_scan(batch: pa.RecordBatch) -> list[str]:
    return [n for n in batch.schema.names if n != "scan"]


def uncarried(rows: DataFrame, *results: Column | str) -> DataFrame:
    return rows.select(*(["row.*"] if "row" in rows.columns else []), *results)


def row_map(column: str, make: Callable[[], Callable[[bytes | None], tuple]], names: list[str], types: list[pa.DataType], drop: tuple[str, ...] = ()):
    """A function for ``mapInArrow``: ``make()`` is called once a task and gives the function of a value.

    The result has the input's columns without ``column`` and ``drop``, then ``names``.
    """

    @lean
    def run(batches):
        function = make()
        for whole in batches:
            for batch in slices(whole, column):
                rows = [function(x) for x in texts(batch, column)]
                keep = [n for n in batch.schema.names if n != column and n not in drop]
                made = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *made], names=[*keep, *names])

    return run
