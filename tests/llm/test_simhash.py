import random

import xxhash

from brandbook.llm import simhash as S


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_masks_cover_every_pair():
    for radius in (1, 2):
        masks = [m % (1 << 64) for m in S.covering_masks(radius)]
        for i in range(64):
            for j in range(64) if radius == 2 else (i,):
                assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


def test_links_are_exact_in_small_and_large_buckets(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    for base in list(values)[:4]:
        for _ in range(40):
            v = base
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                v ^= 1 << b
            values.add(v)
    frame = spark.createDataFrame([(S.signed(v),) for v in values], "fp long")
    want = brute_groups(sorted(values))
    for direct in (32, 2):
        edges = {(r.a % (1 << 64), r.b % (1 << 64)) for r in S.links(frame, 2, direct).collect()}
        assert all((a ^ b).bit_count() <= 2 for a, b in edges)
        root = {v: v for v in values}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        assert len({find(v) for v in values}) == len(set(want.values()))
    near = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in S.links(frame, 1, 2).collect()}
    ordered = sorted(values)
    assert near == {(a, b) for a in ordered for b in ordered if a < b and (a ^ b).bit_count() == 1}


def test_documents(spark):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(50)}" for _ in range(400))
    docs = [(i, text.replace("w7", f"v{i % 3}", 1)) for i in range(20, 28)] + [(1, None), (2, ""), (3, "One"), (3, "one"), (None, "one"), (4, "two words"), (5, "Ünï çödé text here"), (None, "alone without id"), (9, "x " * 30000)]
    frame = spark.createDataFrame([(*d, 1, 2, 3, 4) for d in docs], "doc_id long, text string, fp int, _id int, `group` int, row int")
    rows = S.near_duplicates(frame).collect()
    assert len(rows) == len(docs)
    prints = {t: brute_print(t) for _, t in docs}
    group = brute_groups(sorted(set(prints.values())))
    least = {}
    for d, t in docs:
        g = group[prints[t]]
        if d is not None:
            least[g] = min(d, least.get(g, d))
    want = sorted(str((d, f"{prints[t]:016x}", least.get(group[prints[t]]))) for d, t in docs)
    assert sorted(str(tuple(r)[:3]) for r in rows) == want
    kept = S.keep_one(frame).collect()
    groups = [group[prints[r.text]] for r in kept]
    assert len(groups) == len(set(groups)) == len(set(group.values()))
    assert all(r.doc_id == least.get(group[prints[r.text]]) for r in kept)
    assert S.near_duplicates(frame.limit(0)).count() == 0
