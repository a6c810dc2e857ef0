import hashlib
import re

from brandbook.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, items, window=13):
    words, hit, ids = fold(doc), set(), set()
    for item, text in items:
        w = fold(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for s in range(len(words) - size + 1):
                if words[s : s + size] == w[i : i + size]:
                    hit |= set(range(s, s + size))
                    if item is not None:
                        ids.add(str(item))
    joined = ",".join(sorted(ids))
    return len(words), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def test_against_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(40))
    items = [(1, base), (2, "Alpha, BETA gamma"), (10, "solo"), (3, None), (4, "!!"), (None, "no id here at all"), (1, "second text of one"), (5, "a a a a a a a a a a a a a a a")]
    docs = [
        (1, "x y " + base.upper() + " z", "k"), (2, "alpha beta! Gamma alpha beta gamma", None), (3, None, "k"), (4, "", "k"), (5, "Ünï " * 30 + " solo", "k"),
        (6, " ".join(f"w{i}" for i in range(5, 17)), "k"), (6, " ".join(f"w{i}" for i in range(5, 18)), "k"), (None, "no id here at all", "k"), (7, "a " * 40, "k"), (8, ("pad " * 9000) + base, "k"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (100_000, 7):
        rows = D.digest(D.find_overlaps(frame, bench, block_windows=size)).collect()
        got = sorted(map(str, (tuple(r) for r in rows)))
        assert got == sorted(str((d, *brute(t, items))) for d, t, _ in docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = D.digest(D.find_overlaps(docs, none)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert D.digest(D.find_overlaps(docs.limit(0), none)).count() == 0
