import random

import pytest
from tokenizers import Tokenizer

from brandbook.llm import token_counts as T

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def brute(text, rule):
    encoding, _ = T.encoder(PATH)
    lines = [x + "\n" for x in text.split("\n")]
    lines[-1] = lines[-1][:-1]
    owner = [i for i, x in enumerate(lines) for _ in x.encode()]
    counts, at = [0.0] * len(lines), 0
    for token in encoding.encode_ordinary(text):
        mine = owner[at : at + len(encoding.decode_single_token_bytes(token))]
        at += len(mine)
        if rule == "share":
            for i in mine:
                counts[i] += 1 / len(mine)
        else:
            counts[{"start": mine[0], "end": mine[-1], "majority": max(sorted(set(mine)), key=mine.count)}[rule]] += 1
    return counts


@pytest.mark.parametrize("rule", T.RULES)
def test_against_brute_force(spark, rule):
    rng = random.Random(2)
    texts = [None, "", "\n", "\n\n\n\n", "a\n\n\n   b", "Ünï\nçödé 漢字\n🙂🙂\n", "x" * 3000, " \n \t\n" * 50, "w " * 40_000]
    texts += ["".join(rng.choice(["a", "the ", "\n", "\n\n", " ", "é", "12", "\t", "😀"]) for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, sections string")
    got = {}
    for r in sorted(T.attribute(docs, ["text"], rule=rule, vocabulary=PATH).collect(), key=lambda r: (r.doc_id, r.section)):
        got.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        assert [r.n_tokens for r in got[i]] == pytest.approx(brute(t or "", rule))
        assert "".join((t or "")[r.char_start : r.char_stop] for r in got[i]) == (t or "")
    assert T.attribute(docs.limit(0), ["text"]).count() == 0


def test_fields_and_offsets_of_another_library(spark):
    rows = [(1, "Title of it", " body text, longer"), (2, None, "only body"), (2, None, "only body")]
    docs = spark.createDataFrame(rows, "doc_id long, title string, body string")
    got = sorted((r.doc_id, r.field, r.n_tokens) for r in T.attribute(docs, ["title", "body"], lines=False, rule="start", vocabulary=PATH).collect())
    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    want = []
    for doc, title, body in rows:
        offsets = other.encode((title or "") + body, add_special_tokens=False).offsets
        first = sum(a < len(title or "") for a, _ in offsets)
        want += [(doc, "title", first), (doc, "body", len(offsets) - first)]
    assert got == sorted(want)
    with pytest.raises(ValueError, match="rule"):
        T.attribute(docs, ["title"], rule="none")
