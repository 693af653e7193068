"""The filter audit against filters applied row by row in every order."""

import random
import re
from collections import defaultdict
from itertools import permutations

from lendscope.llm.filter_audit import filter_audit

DOCS = "doc_id long, text string, source string, part string, n string, digest int, bits long"
LABELS = "doc_id long, quality int, toxic int, part string"


def fails(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text))}


def plain_audit(docs, labels):
    first = defaultdict(list)
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""].append(i)
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x, *_ in labels if x == 1 and i is not None}
    rows = defaultdict(list)
    for i, t, s, *_ in docs:
        f = fails(t or "")
        f["E"] = i is not None and min(first[t or ""]) < i
        rows[s or ""].append((i, f))
    out = {}
    for part, held in rows.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            alive = held
            for k, letter in enumerate(order):
                gone = [r for r in alive if r[1][letter]]
                alive = [r for r in alive if not r[1][letter]]
                shapley[letter] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(alive), len(gone), sum(f[letter] for _, f in held) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in held),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def test_equals_filters_applied_in_order(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(500)]
    made = [" ".join(rng.choice(vocab[:rng.choice([40, 500])]) for _ in range(rng.choice([5, 199, 200, 300])))
            + rng.choice(["", " #", " UPPER CASE " * 5, " É", "\x0b\x1c x"]) for _ in range(40)]
    made += [None, "", " \t\n", "a" * 10_000, "A" * 3, "é\x85b"]
    docs = [(rng.randrange(200) if rng.random() < 0.95 else None, rng.choice(made), rng.choice(["a", "b", "", None, "hot"]),
             "x", "y", 1, 2) for _ in range(600)]
    docs += [docs[0]] * 5 + [(10_000 + i, "same text", "hot", "", "", 0, 0) for i in range(300)]
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "z") for _ in range(150)]
    labels += [(None, 1, 1, "z")] + [(10_050 + i, 1, i % 2, "z") for i in range(20)]
    got = filter_audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    want = plain_audit(docs, labels)
    assert len(got) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == want


def test_empty_tables(spark):
    none, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit(none, marks).count() == 0
    one = spark.createDataFrame([(1, "Short & Loud", None, "", "", 0, 0)], DOCS)
    rows = filter_audit(one, marks).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.good_lost for r in rows) == 0
