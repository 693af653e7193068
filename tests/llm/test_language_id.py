"""Language identification: plain-Python counterparts and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lendscope.llm import language_id as L
from lendscope.llm.common import table

SCHEMA = "doc_id long, text string, lang string, held_out string, p int, score string, n_chars long, source string"


def plain_ngrams(text):
    found = Counter()
    for n in range(1, L.LONGEST + 1):
        for i in range(len(text) - n + 1):
            h = 0
            for ch in text[i:i + n]:
                h = (h + ord(ch)) * int(L.MIX) % 2 ** 32
            found[h * L.BUCKETS >> 32] += 1
    return found


@pytest.mark.parametrize("piece", [L.PIECE, 7])
def test_ngrams_equal_a_plain_count(monkeypatch, piece):
    monkeypatch.setattr(L, "PIECE", piece)
    rng = random.Random(3)
    for text in ["Ein Haus, 3 Häuser!", "a", "日本語 \U0001f600 x", "".join(rng.choice("abcdeé ñ") for _ in range(500))]:
        t = L.letters(text)
        at, counts = L.ngram_counts(t)
        assert dict(zip(at.tolist(), counts.tolist())) == plain_ngrams(t)


def test_letters():
    assert L.letters("  Don't 42_x ") == " don t x "
    assert [L.letters(t) for t in (None, "", "12 _ ... \U0001f600")] == ["", "", ""]


def test_leader_equals_the_scalar_rule():
    rng = np.random.default_rng(5)
    leader = L.Ftrl(6, 3, alpha=0.7, beta=1.0, l1=0.05, l2=0.3)
    z, n = [[0.0] * 3 for _ in range(6)], [[0.0] * 3 for _ in range(6)]
    for _ in range(40):
        at = np.sort(rng.choice(6, 3, replace=False))
        x, y = rng.normal(size=3), int(rng.integers(3))
        leader.learn(at, x, y)
        w = [[0.0 if abs(z[f][k]) <= 0.05 else
              -(z[f][k] - math.copysign(0.05, z[f][k])) / ((1.0 + math.sqrt(n[f][k])) / 0.7 + 0.3)
              for k in range(3)] for f in at]
        e = [math.exp(sum(x[i] * w[i][k] for i in range(3))) for k in range(3)]
        for i, f in enumerate(at):
            for k in range(3):
                g = x[i] * (e[k] / sum(e) - (k == y))
                s = (math.sqrt(n[f][k] + g * g) - math.sqrt(n[f][k])) / 0.7
                z[f][k] += g - s * w[i][k]
                n[f][k] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)
    assert (leader.weights(slice(None)) == 0).sum() == sum(abs(v) <= 0.05 for r in z for v in r)


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(300, 4)) * 6
    y = np.array([rng.choice(4, p=L.softmax(r / 3)) for r in logits])
    t = L.fit_temperature(logits, y, np.ones(300))
    loss = lambda s: -np.log(L.softmax(logits / s)[np.arange(300), y]).sum()
    assert 2 < t < 4.5 and all(loss(t) <= loss(t * f) + 1e-9 for f in (0.5, 0.9, 1.1, 2))


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 150 and sum(got[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_frequencies_cover_every_row_and_prediction_equals_a_dictionary(spark):
    rows = [(i, t, lang, "", 0, "", 0, "s") for i, (t, lang) in enumerate(
        [("the house and the tree", "en"), ("das haus und der baum", "de"), ("la casa y el arbol", "es")] * 30)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    df, n = L.frequencies(docs)
    want = Counter(k for r in rows for k in plain_ngrams(L.letters(r[1])))
    assert n == len(rows) and {k: int(df[k]) for k in np.flatnonzero(df)} == dict(want)
    model = L.fit_model(docs)
    for text in ["the tree", "der baum und", "el"]:
        tf = plain_ngrams(L.letters(text))
        x = {k: (1 + math.log(c)) * float(model.idf[k]) for k, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        z = [(sum(v / norm * float(model.weights[k, j]) for k, v in x.items()) + float(model.weights[-1, j]))
             / model.temperature for j in range(3)]
        lang, score = model.predict(text)
        assert lang == model.langs[int(np.argmax(z))]
        assert math.isclose(score, math.exp(max(z)) / sum(map(math.exp, z)), rel_tol=1e-4)


def test_odd_rows(spark):
    taught = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "the and of to " * 3 if k % 2 else "der die das und " * 3, "en" if k % 2 else "de", "x", k, "y", 1, None)
            for k, i in enumerate(taught[:60])]
    rows += [(1000, None, "en", "x", 0, "y", 0, None), (1001, "", "de", "x", 0, "y", 0, None),
             (1002, "12 .. 3", None, "x", 0, "y", 0, None), (None, "die und das", "zz", None, None, None, None, None),
             (1003, "the of " * 200_000, None, "x", 0, "y", 0, None)] + [(1004, "und das", "de", "x", 0, "y", 0, None)] * 3
    got = L.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by[None].lang_pred == "de" and by[None].held_out is False
    assert by[1003].lang_pred == "en" and sum(r.doc_id == 1004 for r in got) == 3
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    mute = spark.createDataFrame([(1, "some words", None, "", 0, "", 0, "")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in L.identify(mute).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(i, "some words", "en", "", 0, "", 0, "") for i in taught[:5]], SCHEMA)
    assert {(r.lang_pred, r.score) for r in L.identify(one).collect()} == {("en", 1.0)}


def test_a_rare_language_is_learnt(spark):
    taught = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "the and of to with", "en", "", 0, "", 0, "") for i in taught[:1500]]
    rows += [(i, "ja nein doch aber", "de", "", 0, "", 0, "") for i in taught[1500:1510]]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = L.fit_model(docs, fit_rows=100)
    assert model.langs == ["de", "en"] and model.predict("nein aber ja")[0] == "de"
