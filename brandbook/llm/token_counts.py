"""Token counts per section from one encoding of the whole document.

A document is the concatenation of its fields; sections are its fields, or the lines of them. It is encoded
once, as a whole, since encoding sections by themselves gives other tokens at the seams. Tokens of a byte-level
vocabulary spell the text, so their byte spans are running sums of the tokens' lengths, and joining these
intervals to the sections' is one binary search over sorted bounds per end. A token within one section counts
there; one that crosses a bound is allocated by ``rule``:

* ``majority``: to the section with most of its bytes, of equals the first (production);
* ``start`` / ``end``: to the section of its first / last byte;
* ``share``: to each section the share of its bytes.

Whatever the rule, the counts of a document sum to its number of tokens.

Edge cases: a null field is empty; an empty document has one empty section per field, with no tokens; a text
of any length is encoded whole; repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from brandbook.llm.arrow import row_map

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how byte-level vocabularies of this kind cut text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("majority", "start", "end", "share")
#: Between the fields of a document in the column that is handed to Python: not a byte of UTF-8.
GLUE = 0xFF


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a ranks file and the byte length of each token."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def allocate(token_lengths: np.ndarray, section_lengths: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, both given by their byte lengths in order."""
    stops, bounds = np.cumsum(token_lengths), np.cumsum(section_lengths)
    starts = stops - token_lengths
    # of empty sections, none holds a byte: searching by the stops of sections passes over them
    first, last = np.searchsorted(bounds, starts, "right"), np.searchsorted(bounds, stops - 1, "right")
    if rule in ("start", "end"):
        return np.bincount(first if rule == "start" else last, minlength=len(section_lengths)).astype(float)
    whole = first == last
    counts = np.bincount(first[whole], minlength=len(section_lengths)).astype(float)
    opens = bounds - section_lengths
    for i in np.flatnonzero(~whole):
        at = np.arange(first[i], last[i] + 1)
        parts = np.minimum(bounds[at], stops[i]) - np.maximum(opens[at], starts[i])
        if rule == "share":
            counts[at] += parts / token_lengths[i]
        else:
            counts[at[np.argmax(parts)]] += 1
    return counts


def sections_of(fields: list[str], lines: bool) -> tuple[list[int], list[int], list[int]]:
    """(field number, characters, bytes) of each section; a line holds the line end after it."""
    numbers, chars, sizes = [], [], []
    for number, value in enumerate(fields):
        for piece in (value.split("\n") if lines else (value,)):
            numbers.append(number)
            chars.append(len(piece) + 1)
            sizes.append(len(piece.encode()) + 1)
        chars[-1] -= 1
        sizes[-1] -= 1
    return numbers, chars, sizes


def count(fields: list[str], encoding: tiktoken.Encoding, lengths: np.ndarray, lines: bool, rule: str) -> list[dict]:
    """The sections of one document."""
    text = "".join(fields)
    tokens = lengths[np.asarray(encoding.encode_ordinary(text), dtype=np.int64)]
    numbers, chars, sizes = sections_of(fields, lines)
    if tokens.sum() != sum(sizes):
        raise ValueError("the tokens don't spell the text; the vocabulary isn't byte-level")
    counts = allocate(tokens, np.asarray(sizes, dtype=np.int64), rule)
    stops = np.cumsum(chars)
    return [{"field": f, "start": int(s - n), "stop": int(s), "tokens": float(c)} for f, s, n, c in zip(numbers, stops, chars, counts, strict=True)]


def attribute(docs: DataFrame, fields: list[str], lines: bool = True, rule: str = "majority", vocabulary: str = VOCABULARY, pattern: str = PATTERN, key: str = "doc_id") -> DataFrame:
    """(doc_id, field, section, char_start, char_stop, n_tokens): one row per section, numbered from 0 in the
    document; spans are character positions in the concatenated fields."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")).cast("binary") for f in fields]
    glued = parts[0]
    for part in parts[1:]:
        glued = F.concat(glued, F.lit(bytes([GLUE])), part)
    slim = docs.select(F.col(key).alias("doc_id"), glued.alias("text"))

    def make():
        encoding, lengths = encoder(vocabulary, pattern)
        return lambda value: (count([x.decode("utf-8", "replace") for x in value.split(bytes([GLUE]))], encoding, lengths, lines, rule),)

    kind = pa.list_(pa.struct([("field", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("tokens", pa.float64())]))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, sections array<struct<field:int,start:bigint,stop:bigint,tokens:double>>"
    found = slim.mapInArrow(row_map("text", make, ["sections"], [kind]), schema)
    names = F.array(*map(F.lit, fields))
    tokens = F.col("s.tokens") if rule == "share" else F.col("s.tokens").cast("bigint")
    rows = found.select("doc_id", F.posexplode("sections").alias("section", "s"))
    return rows.select("doc_id", names[F.col("s.field")].alias("field"), "section", F.col("s.start").alias("char_start"), F.col("s.stop").alias("char_stop"), tokens.alias("n_tokens"))
