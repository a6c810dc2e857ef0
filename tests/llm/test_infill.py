import hashlib
import random
import re

import pytest

from brandbook.llm import infill as I

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in I.MARKS) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def some_texts():
    rng = random.Random(4)
    bits = ["a", "the", " ", "\n", "\t\x0b", "é", "漢", "😀", "\x00", "\xa0", "<P", "P>", "<", "S>", "<M", "\x1c"]
    texts = [None, "", " ", "\n\n ", "word", " x", "x ", "a <P> b", "<S>", "<M>" * 3, "w " * 60_000, "x" * 300_000]
    return texts + ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]


def test_against_brute_force_and_back(spark):
    texts = some_texts()
    rows = [(None if i % 97 == 5 else i, t, i) for i, t in enumerate(texts)] + [(7, "the same text", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, i int").repartition(3)
    made = I.transform(docs, keep=["doc_id", "text"]).withColumn("back", I.restored()).collect()
    order = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=order) == sorted((brute(d, t) for d, t, _ in rows), key=order)
    assert all(r.back == (r.text or "") for r in made)
    assert {r.form for r in made} == {"plain", "spm", "psm"}
    assert I.digest(I.transform(docs.limit(0))).count() == 0


def test_other_marks_rates_and_names(spark):
    docs = spark.createDataFrame([(i, "a b c d", "x") for i in range(40)], "doc_id long, text string, unit string")
    made = I.transform(docs, cut=100, suffix_first=0, marks=("[pre'", "{suf", "|mid"))
    assert made.columns == ["doc_id", "unit", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("back", I.restored(marks=("[pre'", "{suf", "|mid"))).collect()
    assert {(r.form, r.back) for r in found} == {("psm", "a b c d")} and all(r.output.startswith("[pre'") for r in found)
    with pytest.raises(ValueError, match="marks"):
        I.transform(docs, marks=("<a<", "<b", "c"))
    with pytest.raises(ValueError, match="named like"):
        I.transform(docs.withColumnRenamed("unit", "form"))


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61ff62' AS string) AS text")
    assert I.transform(docs, keep=["doc_id"]).select(I.restored()).first()[0] == "a�b"
