"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark: each run of 13 words of an item, or a whole item of fewer
words. A matcher holds patterns of one length m. Its shift table maps a block of up to three words to the
least distance from that block to the end of a pattern; a block that is in no pattern moves the search by
m - 2 words at once. Where the shift is zero, the block's bucket names the patterns that end with it, their
first words are looked at, and a word-by-word comparison confirms each occurrence. Long and short patterns
have matchers of their own, so that one short item does not shorten every shift.

The benchmark is the stated query set. It is read in blocks of at most ``block_windows`` windows, one partition at
a time; ``PASS_BLOCKS`` blocks are searched in one pass over the rows, each a broadcast of bounded size. Where more
follow, the rows are written with what was found and the broadcasts released before the next pass. So a benchmark of
any size is searched whole, without a shuffle, and neither driver nor tasks hold more than a pass's blocks.

Edge cases: a null or empty text, and one without words, has no words and no hits; items without words or
without text have no windows; an item without ``item_id`` still marks words but is not counted or named;
several rows with one id are one item; rows of ``docs`` stay as they are, repeated ones too; a text's length isn't
limited; an empty table of either gives no rows or no hits; a column of ``docs`` that is named like a result column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brandbook.llm.arrow import carried, lean, slices, texts, uncarried
from brandbook.session import materialise

WINDOW = 13
BLOCK = 3
BLOCK_WINDOWS = 100_000
PASS_BLOCKS = 2
SPAN = "array<struct<start:int,stop:int>>"

#: Bytes to bytes: A-Z to a-z, other ASCII but digits and letters to a space, the rest as it is.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters of a UTF-8 text."""
    return (text or b"").translate(_FOLD).split()


class WuManber:
    """Finds every occurrence of patterns (tuples of words, all of one length)."""

    def __init__(self, patterns: dict[tuple, list], length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.ends: dict[tuple, list[tuple]] = {}
        for pattern in patterns:
            for stop in range(self.block, length + 1):
                key = pattern[stop - self.block : stop]
                self.shift[key] = min(self.shift.get(key, self.most), length - stop)
            self.ends.setdefault(pattern[length - self.block :], []).append(pattern)
        self.patterns = patterns

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(start, pattern) of each occurrence, by start."""
        shift, most, length, block, n = self.shift.get, self.most, self.length, self.block, len(words)
        at = length
        while at <= n:
            key = tuple(words[at - block : at])
            step = shift(key, most)
            if step:
                at += step
                continue
            start = at - length
            first = words[start]
            for pattern in self.ends[key]:
                if pattern[0] == first and pattern == tuple(words[start:at]):
                    yield start, pattern
            at += 1


class Matcher:
    """Matchers for all windows of one block of items."""

    def __init__(self, segments: list[tuple[str | None, tuple]], window: int):
        by_length: dict[int, dict[tuple, list]] = {}
        for item, words in segments:
            size = min(window, len(words))
            for i in range(len(words) - size + 1):
                owners = by_length.setdefault(size, {}).setdefault(tuple(words[i : i + size]), [])
                if item is not None and item not in owners:
                    owners.append(item)
        self.passes = [WuManber(p, size) for size, p in sorted(by_length.items())]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        spans, items = [], set()
        for one in self.passes:
            for start, pattern in one.search(words):
                spans.append((start, start + one.length))
                items.update(one.patterns[pattern])
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same positions."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, text: str = "text", item: str = "item_id") -> Iterator[list[tuple[str | None, tuple]]]:
    """The items as (id, words) segments, in blocks; an item with too many windows is cut with overlap."""
    block: list[tuple[str | None, tuple]] = []
    held = 0
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.text) if row.text is not None else None)
        for at in range(0, max(1, len(words) - window + 1) if words else 0, block_windows):
            segment = tuple(words[at : at + block_windows + window - 1])
            if held and held + len(segment) > block_windows + window:
                yield block
                block, held = [], 0
            block.append((row.item, segment))
            held += len(segment)
    if block:
        yield block


def _scan_pass(shared: list, window: int, text: str):
    """One pass over Arrow batches: counts words, adds these blocks' spans and items to those before."""
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    @lean
    def run(batches):
        matchers = [Matcher(block.value, window) for block in shared]
        for whole in batches:
            for batch in slices(whole, text):
                counts, spans, items = [], [], []
                before = zip(batch.column("hit_spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
                for value, (old_spans, old_items) in zip(texts(batch, text), before, strict=True):
                    words = words_of(value)
                    found, named = [(s["start"], s["stop"]) for s in old_spans or ()], set(old_items or ())
                    for matcher in matchers:
                        more, names = matcher.scan(words)
                        found += more
                        named |= names
                    counts.append(len(words))
                    spans.append([{"start": a, "stop": b} for a, b in merged(found)])
                    items.append(sorted(named))
                made = {"n_words": pa.array(counts, pa.int64()), "hit_spans": pa.array(spans, span_type), "items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([made.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)], names=batch.schema.names)

    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs`` with n_words, hit_spans (disjoint word positions),
    items (sorted ids of the items that occur), n_hit, n_items and contaminated."""
    results = ["n_words", "hit_spans", "items", "n_hit", "n_items", "contaminated"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in results]
    context = docs.sparkSession.sparkContext
    start = [F.lit(0).cast("bigint").alias("n_words"), F.array().cast(SPAN).alias("hit_spans"), F.array().cast("array<string>").alias("items")]
    scanned, path = carried(docs, kept, text, *start)
    blocks = benchmark_blocks(benchmark, window, block_windows)
    group, more = list(islice(blocks, PASS_BLOCKS)), True
    while more:
        following = list(islice(blocks, PASS_BLOCKS))
        shared = [context.broadcast(block) for block in group]
        scanned = scanned.mapInArrow(_scan_pass(shared, window, path), scanned.schema)
        if more := bool(following):
            scanned = materialise(scanned, "overlaps")
            for block in shared:
                block.destroy()
        group = following
    hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda total, s: total + s["stop"] - s["start"])
    counted = uncarried(scanned, "n_words", "hit_spans", "items", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(overlaps: DataFrame) -> DataFrame:
    """Per document the numbers and the SHA-256 of the comma-joined ids."""
    return overlaps.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
