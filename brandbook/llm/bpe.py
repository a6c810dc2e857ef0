"""Byte-pair encoding of whole texts with a word-end vocabulary, and decoding.

White space separates the words of such a vocabulary and is dropped, so a text is the sequence of its runs without
white space, and equal runs have equal ids wherever they stand: a task looks runs, and then their pieces, up in bounded memos
and works only on new ones. A run is cut at special tokens, then normalised and split into pieces by the rules
that the vocabulary file states: below U+0250, where they are plain, by a pattern of this module, else by the vocabulary's
library, whose Unicode tables they are. Each piece is merged here:

* a short piece is a contiguous array of part boundaries with the rank of each adjacent pair beside it; the least rank
  (of equal ones the leftmost) is found by a scan, its inner boundary deleted, and the two neighbouring ranks made anew;
* scanning a long piece would cost its length squared, so there the same merges come from a heap over linked parts.

``encode`` gives ids as little-endian unsigned 32-bit integers in one binary value, ``decode`` the tokens' strings joined by
one space, as for a vocabulary without a decoder.

Texts are rows of their own: no shuffle, no state between rows but the memo, which only saves time. The vocabulary
file is handed to executors by Spark. Edge cases: a null text is empty; an empty one has no ids; bytes that
aren't UTF-8 are replaced as Spark does; a text or a word of any length is encoded whole; repeated rows stay; an empty table
gives no rows; a kept column named like the result is refused; ids that the vocabulary lacks, and a null, decode to nothing.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from brandbook.llm.arrow import carried, slices, texts, uncarried, without_scan

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Parts up to which a piece is scanned.
SHORT = 64
#: Runs, and pieces, that a task remembers in each of two generations, and the characters of the longest one that it does.
MEMO, MEMO_CHARS = 150_000, 64
#: How the vocabulary's rules split lower-cased runs of characters below U+0250.
PLAIN_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼½¾]+|[\\d²³¹¼½¾]|[\\W_]+")
NOT_PLAIN = re.compile("[^\x00-\u024f]")
STATED = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: What the vocabulary's rules hold for white space; and what str.split takes for white space besides.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
MORE_SPACE = re.compile("[\x1c-\x1f]")
NO_RANK = 1 << 62


class Memo(dict):
    """Bytes by text. It never has more than ``MEMO`` entries, nor does the generation before it, from which what is still in use is
    taken back; the rest falls."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found


class Vocabulary:
    """What a vocabulary file holds, and the ids of a run by it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, splitting = said["model"], said["pre_tokenizer"]
        steps = splitting.get("pretokenizers", [splitting]) if splitting else [{}]
        drops_space = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
        plain = not (said["post_processor"] or said["decoder"] or model["unk_token"] or model["dropout"] or model["byte_fallback"])
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or not drops_space or not plain:
            raise ValueError(f"{path} isn't a BPE vocabulary with word ends that drops white space")
        self.ids, self.end = model["vocab"], model["end_of_word_suffix"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.special = {token["content"]: token["id"] for token in said["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(token) for token in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        rules = Tokenizer.from_file(path)
        self.normalise, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        lowers = any(step.get("type") == "Lowercase" for step in (said["normalizer"] or {}).get("normalizers", []))
        self.plain = lowers and steps[0].get("pattern") == {"Regex": STATED}
        # bytes as characters: the printable ones stand for themselves, the others for characters from U+0100 on
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        hidden = [b for b in range(256) if b not in shown]
        chars = {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}
        self.bytes = {ord(c): chr(b) for b, c in chars.items()}
        self.inner = [self.ids.get(chars[b]) for b in range(256)]
        self.last = [self.ids.get(chars[b] + self.end) for b in range(256)]
        self.runs, self.pieces = Memo(self.of_run), Memo(self.of_piece)
        names = {**{i: token for token, i in self.ids.items()}, **{i: token for token, i in self.special.items()}}
        self.names = np.array([names.get(i) for i in range(max(names) + 1)], dtype=object)

    def of_piece(self, piece: str) -> bytes:
        """The packed ids of a piece; bytes without an id fall."""
        *inner, last = piece.encode()
        found = [*map(self.inner.__getitem__, inner), self.last[last]]
        if None in found:
            found = [i for i in found if i is not None]
        return packed(merged(found, self.merges))

    def pieces_of(self, run: str) -> list[str]:
        """A run without special tokens, normalised and split."""
        if self.plain and not NOT_PLAIN.search(run):
            return PLAIN_PIECE.findall(run.lower())
        return [shown.translate(self.bytes).encode("latin-1").decode() for shown, _ in self.split(self.normalise(run))]

    def of_run(self, run: str) -> bytes:
        """The packed ids of a text without white space."""
        pieces = self.pieces
        if not self.cut or not self.cut.search(run):
            return b"".join([pieces[piece] for piece in self.pieces_of(run)]) if run else b""
        parts = []
        for n, part in enumerate(self.cut.split(run)):
            if n % 2:
                parts.append(packed([self.special[part]]))
            elif part:
                parts += [pieces[piece] for piece in self.pieces_of(part)]
        return b"".join(parts)

    def of_text(self, text: str) -> bytes:
        """The packed ids of a text."""
        runs = self.runs
        return b"".join([runs[run] for run in (SPACE.split(text) if MORE_SPACE.search(text) else text.split())])

    def spelled(self, ids: bytes | None) -> str:
        """The tokens of packed ids, with one space between them."""
        ids = np.frombuffer(ids or b"", dtype="<u4")
        found = self.names[ids[ids < len(self.names)]]
        return " ".join(token for token in found.tolist() if token is not None)


def packed(ids: list[int]) -> bytes:
    """``ids`` as little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def merged(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``parts`` after all merges, least rank first, of equal ranks the leftmost."""
    return scanned(parts, merges) if len(parts) <= SHORT else heaped(parts, merges)


def scanned(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The merges of a short piece: ``ranks[k]`` is the rank of the pair of parts k and k + 1."""
    none = (NO_RANK, -1)
    parts = list(parts)
    ranks = [merges.get(pair, none)[0] for pair in zip(parts, parts[1:], strict=False)]
    while ranks:
        least = min(ranks)
        if least == NO_RANK:
            break
        at = ranks.index(least)
        parts[at : at + 2] = [merges[parts[at], parts[at + 1]][1]]
        del ranks[at]
        if at:
            ranks[at - 1] = merges.get((parts[at - 1], parts[at]), none)[0]
        if at < len(ranks):
            ranks[at] = merges.get((parts[at], parts[at + 1]), none)[0]
    return parts


def heaped(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges in time n log n: pairs in a heap by rank and place, those of parts changed since fall when they come up."""
    parts, n = list(parts), len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(merges[pair][0], k, *pair) for k, pair in enumerate(zip(parts, parts[1:], strict=False)) if pair in merges]
    heapify(heap)
    while heap:
        _, at, left, right = heappop(heap)
        follow = after[at]
        if parts[at] != left or follow >= n or parts[follow] != right:
            continue
        parts[at], parts[follow] = merges[left, right][1], -1
        after[at] = after[follow]
        if after[at] < n:
            before[after[at]] = at
            if (pair := (parts[at], parts[after[at]])) in merges:
                heappush(heap, (merges[pair][0], at, *pair))
        if before[at] >= 0 and (pair := (parts[before[at]], parts[at])) in merges:
            heappush(heap, (merges[pair][0], before[at], *pair))
    return [part for part in parts if part != -1]


@lru_cache(maxsize=2)
def _opened(path: str) -> Vocabulary:
    return Vocabulary(path)


def handed_out(spark: SparkSession, path: str):
    """A function that opens the vocabulary in a task; its file goes to executors with Spark's files."""
    spark.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]
    return lambda: _opened(SparkFiles.get(name))


def _mapped(rows: DataFrame, path: str, open_vocabulary, work, name: str, kind: pa.DataType, sql_type: str) -> DataFrame:
    """``rows`` with ``work(vocabulary, value)`` of each value at ``path`` as ``name``."""

    def run(batches):
        vocabulary = open_vocabulary()
        for received in batches:
            for batch in slices(received, path):
                made = pa.array([work(vocabulary, value) for value in texts(batch, path)], type=kind)
                kept = without_scan(batch)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), made], names=[*kept, name])

    schema = [f"row {rows.schema['row'].dataType.simpleString()}"] if "row" in rows.columns else []
    return uncarried(rows.mapInArrow(run, ", ".join([*schema, f"{name} {sql_type}"])), name)


def encode(docs: DataFrame, keep: list[str] | None = None, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all but the text, unless given) with ``ids``."""
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    if "ids" in kept:
        raise ValueError("a column is named like the result: ids")
    whole = docs.withColumn(text, F.make_valid_utf8(F.coalesce(F.col(text), F.lit(""))))
    rows, path = carried(whole, kept, text)
    return _mapped(rows, path, handed_out(docs.sparkSession, vocabulary), lambda v, value: v.of_text(value.decode()), "ids", pa.binary(), "binary")


def decode(encoded: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids; a column of that name is refused."""
    if "decoded" in encoded.columns:
        raise ValueError("a column is named like the result: decoded")
    rows, path = carried(encoded, encoded.columns, ids)
    return _mapped(rows, path, handed_out(encoded.sparkSession, vocabulary), lambda v, value: v.spelled(value), "decoded", pa.string(), "string")


def digest(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of ids and digests in place of ids and decoded text."""
    found = [
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns if c not in ("ids", "decoded")), *found)
