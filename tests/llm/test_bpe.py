import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from brandbook.llm import bpe as B
from tests import oracle


def unpacked(ids):
    return np.frombuffer(ids, dtype="<u4").tolist()


def some_texts():
    rng = random.Random(8)
    bits = ["a", "The ", "ing", "'s", "'LL", " ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "é", "é", "İ", "Σ", "ΑΣ", "漢字", "한", "하", "😀", "12", "½", "!?", "_", "́", "​", "﻿", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|end", "\x00", "Ǆ", "ﬁ", "\U00010d50"]
    texts = [None, "", " ", "\n\t ", "word", "A" * 5000, "ab" * 3000 + "!" * 700, "word " * 30_000, "x" + "́" * 300, "don't we're I'M they'd", "1234567", "a b"]
    return texts + ["".join(rng.choice(bits) for _ in range(rng.randrange(80))) for _ in range(500)]


def test_against_the_library(spark):
    other = Tokenizer.from_file(B.VOCABULARY)
    texts = some_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string").repartition(3)
    got = B.decode(B.encode(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = other.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert unpacked(r.ids) == ids
        assert r.decoded == other.decode(ids, skip_special_tokens=False)
    assert B.digest(B.decode(B.encode(docs.limit(0)))).count() == 0


def test_every_character_alone_and_beside_letters():
    other, own = Tokenizer.from_file(B.VOCABULARY), B.Vocabulary(B.VOCABULARY)
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert own.plain
    texts = ["".join(f"a{c}b {c} 1{c}! " for c in points[at : at + 64]) for at in range(0, len(points), 64)]
    for text, want in zip(texts, other.encode_batch(texts, add_special_tokens=False), strict=True):
        assert unpacked(own.of_text(text)) == want.ids


@pytest.mark.skipif(not oracle.DATA.exists(), reason="the driver's tables aren't here")
def test_whole_table_against_the_library(spark):
    other = Tokenizer.from_file(B.VOCABULARY)
    docs = spark.read.parquet(f"{oracle.DATA}/documents.parquet")
    for r in B.decode(B.encode(docs, keep=["doc_id", "text"])).collect():
        ids = other.encode(r.text or "", add_special_tokens=False).ids
        assert unpacked(r.ids) == ids and r.decoded == other.decode(ids, skip_special_tokens=False)


def test_scan_and_heap_merge_alike():
    rng = random.Random(1)
    merges = {}
    for rank in range(60):
        pair = (rng.randrange(12), rng.randrange(12))
        merges.setdefault(pair, (rank, rng.randrange(12)))
    for _ in range(500):
        parts = [rng.randrange(12) for _ in range(rng.randrange(1, 90))]
        assert B.scanned(parts, merges) == B.heaped(parts, merges) == slowly(parts, merges)


def slowly(parts, merges):
    parts = list(parts)
    while found := [(merges[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in merges]:
        k = min(found)[1]
        parts[k : k + 2] = [merges[parts[k], parts[k + 1]][1]]
    return parts


def test_memo_is_bounded_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(B, "MEMO", 3)
    own, fresh = B.Vocabulary(B.VOCABULARY), B.Vocabulary(B.VOCABULARY)
    for text in ["one two three four five one", "six one seven", "x" * 100]:
        assert own.of_text(text) == b"".join(fresh.of_run(run) for run in text.split())
        assert max(map(len, (own.runs, own.runs.old, own.pieces, own.pieces.old))) <= 3


def test_refusals(spark):
    docs = spark.createDataFrame([(1, "a", b"x")], "doc_id long, text string, ids binary")
    with pytest.raises(ValueError, match="ids"):
        B.encode(docs)
    with pytest.raises(ValueError, match="word ends"):
        B.Vocabulary("/opt/tokenizers/byte_bpe_50k.json")
    unknown = np.asarray([0, 999_999, 1], dtype="<u4").tobytes()
    rows = spark.createDataFrame([(1, unknown), (2, None)], "doc_id long, ids binary")
    assert sorted((r.doc_id, r.decoded) for r in B.decode(rows).collect()) == [(1, '! "'), (2, "")]
