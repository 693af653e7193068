"""Template decontamination: planted copies, re-parameterised questions, brute force."""

import random

import pytest

from lendscope.llm import decontaminate as D
from lendscope.llm.decontaminate import LITERAL, Templates, _tokens, decontaminate, kind, leaks

DOCS = "doc_id long, text string, h string, item_id int, source string"
ITEMS = "item_id long, text string, doc_id string"

Q = ("a farmer sells 12 kg of apples to Marta and 7 kg of apples to Paul for 3 dollars each, "
     "how many dollars does the farmer take from Marta and Paul on that day in total")
SAME = Q.replace("12", "45").replace("7", "8").replace("Marta", "Ines").replace("Paul", "Otto").replace("kg", "pounds")
MIXED = SAME.replace("from Ines and Otto", "from Otto and Hugo")        # slots do not correspond
REORDERED = " ".join(sorted(Q.split()))


def filler(rng, n):
    return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "Amet", "3", "kg", "of", "the", "in"]) for _ in range(n))


def test_planted(spark):
    rng = random.Random(4)
    items = [(1, Q, "x"), (2, "what is the capital of the old kingdom by the northern sea", "x"), (3, "too short", "x"),
             (4, None, None), (None, "an item that has no id but has enough words to be told", "x"), (5, "", "x"),
             (1, Q, "x"), (6, " ".join(["7", "8", "9", "10", "11", "12", "13"]), "y")]
    f = lambda n: filler(rng, n)
    docs = [(10, f(50) + " " + Q + " " + f(50), "h", 1, "s"), (11, f(30) + " " + SAME, "h", 1, "s"),
            (12, f(30) + " " + MIXED, "h", 1, "s"), (13, REORDERED, "h", 1, "s"),
            (14, f(9000) + " what is the capital of the old kingdom by the northern sea " + f(30_000), "h", 1, "s"),
            (15, "what is the capital of the old", "h", 1, "s"), (16, None, None, None, None), (17, "", "h", 1, "s"),
            (None, "an item that has no id but has enough words to be told", "h", 1, "s"),
            (18, "it is too short", "h", 1, "s"), (19, f(4000), "h", 1, "s"), (10, f(20), "h", 1, "s"),
            (20, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "h", 1, "s"), (21, "17 18 19 20 21 22 23", "h", 1, "s")]
    docs = docs + [docs[0]]
    d, b = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched) for r in leaks(d, b).collect()}
    assert set(got) == {(10, 1), (11, 1), (14, 2), (None, None), (20, 6)}
    assert got[(11, 1)][0] == got[(11, 1)][1] == len(_tokens(Q)) - 4
    kept = decontaminate(d, b)
    assert kept.columns == d.columns
    gone = {(10, docs[0][1]), (11, docs[1][1]), (14, docs[4][1]), (None, docs[8][1]), (20, docs[12][1])}
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(str(r) for r in docs if r[:2] not in gone)


def brute(docs, items, share=0.8):
    make = Templates()
    out = set()

    def rows(text):
        toks = _tokens(text)
        _, kinds, template = make.windows(text)
        res = []
        for i in range(len(toks) - 4):
            w = toks[i:i + 5]
            ks = kinds[i:i + 5]
            if (ks == LITERAL).sum() >= 2:
                res.append((tuple(t.lower() if k == 0 else int(k) for t, k in zip(w, ks)),
                            [t.lower() for t, k in zip(w, ks) if k]))
            else:
                res.append((("raw", *(t.lower() for t in w)), []))
        return res

    for d, text in docs:
        dw = rows(text)
        for b, item in items:
            iw = rows(item)
            by = {}
            for i, (a, s) in enumerate(iw):
                for j, (c, t) in enumerate(dw):
                    if a == c:
                        by.setdefault(j - i, []).append((i, list(zip(s, t))))
            pos = set()
            for hits in by.values():
                seen = {}
                if all(seen.setdefault(x, y) == y for _, ps in hits for x, y in ps):
                    pos |= {i for i, _ in hits}
            if iw and len(pos) >= share * len(iw):
                out.add((d, b))
    return out


@pytest.mark.parametrize("run", [D.RUN_TOKENS, 30])
def test_same_as_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(D, "RUN_TOKENS", run)
    rng = random.Random(8)
    vocab = ["the", "of", "red", "Ann", "Bob", "3", "12", "km", "seven", "and", "Run", "go"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(5, 12))) for i in range(40)]
    docs = []
    for i in range(120):
        words = text(rng.randint(3, 40)).split()
        at = rng.randrange(len(words))
        words[at:at] = [rng.choice(["Ann", "Bob", "Cy"]) if kind(w) == 2 else w for w in rng.choice(items)[1].split()]
        docs.append((i, " ".join(words)))
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                                spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items) and len(got) > 50


def test_empty(spark):
    d, b = spark.createDataFrame([(1, Q, "", 1, "")], DOCS), spark.createDataFrame([], ITEMS)
    assert leaks(d, b).count() == 0 and decontaminate(d, b).count() == 1
    assert leaks(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, Q, "")], ITEMS)).count() == 0


def test_copies_in_other_case(spark):
    rng = random.Random(5)
    items = [(1, Q, "x"), (2, "The old King of Spain met the Duke of Parma near Straße 5 in the year when the War began", "x")]
    caps = Q.replace("12", "45").replace("7", "8").replace("kg", "pounds").upper()
    docs = [(10 * i + k, filler(rng, 40) + " " + c + " " + filler(rng, 40), "h", 1, "s")
            for i, q, _ in items for k, c in enumerate([q, q.upper(), q.lower(), q.title()])]
    docs += [(30, caps, "h", 1, "s"), (31, MIXED.upper(), "h", 1, "s"), (32, " ".join(reversed(Q.upper().split())), "h", 1, "s")]
    # one changed number makes the alignment's values conflict; the windows in other case are the item's word for word
    far = "12 of the " + " ".join(rng.choice(["Red the", "Green of", "Blue warm", "Cold dark"]) for _ in range(20)) + " and 12 of them"
    items.append((3, far, "x"))
    docs += [(33, far[:-len("12 of them")].upper() + "13 of them", "h", 1, "s")]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    want = {(10 * i + k, i) for i in (1, 2) for k in range(4)}
    want.add((33, 3))
    assert want | {(30, 1)} == got


def test_unit_at_a_window_start_is_a_plain_word(spark):
    item = "days of wine and roses they laugh and run away"
    docs = spark.createDataFrame([(1, "after 3 DAYS of wine AND roses they laugh and run away home", "", 1, "")], DOCS)
    rows = leaks(docs, spark.createDataFrame([(1, item, "")], ITEMS)).collect()
    assert [(r.n_windows, r.n_matched) for r in rows] == [(6, 6)]


def test_short_items_and_scripts_without_blanks(spark):
    rng = random.Random(6)
    items = [(1, "Name four gases", "x"), (2, "水的沸点是多少度呢", "x"), (3, "Paris", "x"), (4, "too short", "x"),
             (5, "2 + 2", "x"), (6, "ประเทศไทย", "x"), (7, "...", "x"), (8, "list 3 prime numbers", "x")]
    f = lambda n: filler(rng, n)
    docs = [(10, f(30) + " name four GASES " + f(30), "h", 1, "s"), (11, f(9) + "。水的沸点是多少度呢？" + f(9), "h", 1, "s"),
            (12, "we went to Paris in May", "h", 1, "s"), (13, "Paris", "h", 1, "s"), (14, "it is too short", "h", 1, "s"),
            (15, "Too short!", "h", 1, "s"), (16, "name five gases", "h", 1, "s"), (17, "水的温度是多少度", "h", 1, "s"),
            (18, "ในประเทศไทยมี", "h", 1, "s"), (19, "please list 5 prime numbers now", "h", 1, "s"), (20, "...", "h", 1, "s"),
            (21, "name four", "h", 1, "s"), (22, "水" * 100_000, "h", 1, "s")]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(10, 1), (11, 2), (13, 3), (15, 4), (16, 1), (18, 6), (19, 8)}      # 16 and 19: another number
