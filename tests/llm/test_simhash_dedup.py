"""SimHash near-duplicates against a plain Python version."""

import random
import re

import numpy as np
import xxhash

from lendscope.llm.components import components
from lendscope.llm.simhash_dedup import fingerprint, forest, half_offsets, keep_one, links, near_duplicates

SCHEMA = "doc_id long, text string, fp string, root int, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def plain_components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def corpus(seed=2):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(60)] + ["Émile", "ÀB", "a b", "x y", "\x1cq"]
    rows = []
    for i in range(160):
        if rows and rng.random() < 0.4:
            words = rng.choice(rows)[1].split(" ")
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        else:
            words = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 300, 900]))]
        text = " ".join(words)
        rows.append((1000 - i, text.upper() if rng.random() < 0.1 else text, "f", 1, "s"))
    return rows + [(1, "", "f", 1, "s"), (2, None, None, None, None), (3, " \t\n", "f", 1, "s"),
                   (None, rows[5][1], "f", 1, "s"), (None, "only without id", "f", 1, "s"),
                   rows[7], rows[7], (4, "big " * 120_000, "f", 1, "s")]


def test_fingerprints_and_components_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    prints = [plain_print(r[1]) for r in rows[:-1]] + [fingerprint(rows[-1][1])]
    assert [fingerprint(r[1] or "") for r in rows] == prints
    roots = plain_components(prints, 3)
    smallest = {}
    for r, k in zip(rows, roots):
        if r[0] is not None:
            smallest[k] = min(smallest.get(k, r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", smallest.get(k)) for r, p, k in zip(rows, prints, roots)), key=str)
    assert len(set(roots)) < len(set(prints))              # some different fingerprints are linked
    for parts in (2, 4, 8):
        got = sorted(map(tuple, near_duplicates(docs, parts=parts).collect()), key=str)
        assert got == want
    kept = keep_one(docs).collect()
    assert kept[0].__fields__ == docs.columns and len(kept) == len(set(roots))
    by_row = {tuple(r): k for r, k in zip(rows, roots)}
    assert len({by_row[tuple(r)] for r in kept}) == len(kept)
    assert {r.doc_id for r in kept} == {smallest.get(k) for k in set(roots)}


def test_links_of_many_near_prints_in_pieces(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    values = {base}
    for _ in range(900):                                   # a dense group and noise
        v = rng.choice(sorted(values))
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values = sorted(values | {rng.getrandbits(64) for _ in range(200)})
    want = plain_components(values, 3)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    for parts in (2, 4):
        edges = links(prints, parts=parts, tile=20)
        assert edges.count() < len(values) * 40
        root = dict(map(tuple, components(edges).collect()))
        groups = {}
        for v, k in zip(signed, want):
            groups.setdefault(k, set()).add(root.get(v, v))
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)


def test_forest_spans_and_offsets():
    a = np.array([0, 1, 3, 7, 15, 1 << 40 | 1 << 50], dtype=np.uint64)
    assert len(forest(a, a, True, 1)) == 4
    assert len(forest(a[:2], a[2:], False, 1)) == 1
    assert [len(half_offsets(p, 3)) for p in (2, 4, 8)] == [13, 65, 417]


def test_empty_and_components(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0
    edges = spark.createDataFrame([(1, 2), (2, 1), (5, 4), (4, 3), (2, 9), (7, 7), (None, 3)], "u long, v long")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (7, 7), (9, 1)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert {r.root for r in components(chain).collect()} == {0}
