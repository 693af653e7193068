"""Toxicity by compression distance: held-out accuracy and odd rows."""

import random
import zlib

import numpy as np
import zstandard as zstd

from lendscope.llm import toxicity as T
from lendscope.llm.toxicity import Gains, dictionaries, drop_toxic, features, fit, score_toxicity, spans

BAD = ["grumbler", "dolt", "wretch", "blighter"]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    parts = ["an", "tel", "ro", "mi", "sed", "ur", "na", "vol", "ke", "st"]
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 300))]
        bad = i % 5 == 0
        for _ in range(4 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "s", "x"))
        if i % 10 < 6:
            marks.append((i, int(bad), 1))
    return rows, marks


DOCS = "doc_id long, text string, source string, score string"
MARKS = "doc_id long, toxic int, quality int"


def test_held_out_accuracy_and_odd_rows(spark):
    rows, marks = corpus()
    far = " ".join(["anro"] * 20_000) + " dolt wretch blighter grumbler" * 400      # toxic far into a long text
    odd = [(None, "anro dolt", "s", "x"), (5000, None, "s", None), (5001, "", None, "x"), (5002, far, "s", "x"),
           (7, rows[7][1], "s", "x")]
    docs = spark.createDataFrame(rows + odd, DOCS).repartition(4)
    labels = spark.createDataFrame(marks + [(None, 1, 1), (3, None, 1), (99999, 1, 1)], MARKS)
    out = score_toxicity(docs, labels).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r.doc_id: r for r in out}
    right = [got[i].predicted == int(i % 5 == 0) for i, *_ in rows if got[i].held_out]
    assert len(right) > 200 and sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert got[5002].predicted == 1 and got[5000].predicted == 0 and got[5000].score == got[5001].score
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in docs.collect() if r.doc_id is not None and not got[r.doc_id].predicted
        or r.doc_id is None and not [x for x in out if x.doc_id is None][0].predicted)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x")], DOCS)
    none = spark.createDataFrame([], MARKS)
    assert [(r.score, r.predicted) for r in score_toxicity(docs, none).collect()] == [(0.0, 0)]
    assert score_toxicity(spark.createDataFrame([], DOCS), none).count() == 0
    one = spark.createDataFrame([(1, 0, 1)], MARKS)
    assert score_toxicity(docs, one).first().score == 0.0


def test_a_learnt_window_gains_and_others_do_not():
    rows, marks = corpus()
    bad = {i for i, t, _ in marks if t}
    plain, toxic = dictionaries([t for i, t, *_ in rows if i in bad], [t for i, t, *_ in rows if i not in bad])
    g = Gains(plain, toxic)
    assert all(g.of(f"anro {w} telmi sedurna").max() >= 1 for w in BAD)
    assert max(g.of(w).max() for w in ("anro telmi vol nasedke", "telmi stan", "sedurna rourna mi tel")) < 1


def windows(text):
    words = text.lower().encode().split()
    return [b" " + b" ".join(words[i:j]) + b" " for i, j in spans([len(w) for w in words])]


def test_windows_hold_every_word():
    rng = random.Random(1)
    for _ in range(200):
        words = ["".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 9, 40]))) for _ in range(rng.randint(0, 30))]
        held = windows(" ".join(words))
        assert {w.encode() for w in words} == {x for w in held for x in w.split()}
        assert all(len(w) - 1 >= T.WINDOW_BYTES for w in held[:-1])


def plain_length(content, text):
    """Length of one window by a coder made anew for it."""
    how = zstd.ZstdCompressionParameters(
        format=zstd.FORMAT_ZSTD1_MAGICLESS, compression_level=3, strategy=zstd.STRATEGY_BTLAZY2, min_match=3, window_log=18,
        hash_log=17, chain_log=18, search_log=5, target_length=64, write_content_size=0, write_checksum=0, write_dict_id=0)
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    return len(zstd.ZstdCompressor(dict_data=d, compression_params=how).compress(text))


def test_scores_come_from_compression_lengths_alone():
    rows, marks = corpus(400)
    mark = dict((i, t) for i, t, _ in marks)
    taught = [(t, mark[i]) for i, t, *_ in rows if i in mark]
    model = fit([t for t, _ in taught], [m for _, m in taught])
    gains = Gains(model.ordinary, model.toxic)
    for text in [rows[0][1], rows[1][1], "", "one"]:
        lead = model.ordinary[-600:-552]
        want = [plain_length(model.ordinary, lead + w + T.TAIL) - plain_length(model.toxic + model.ordinary, lead + w + T.TAIL)
                if any(w[k:k + T.SHARED] in model.toxic for k in range(len(w) - T.SHARED + 1)) else 0 for w in windows(text)]
        assert gains.of(text).tolist() == want
    # without the toxic dictionary nothing tells toxic texts from others: scores of equally long texts are equal
    none = Gains(model.ordinary, b"")
    assert all(not none.of(t).any() for t, _ in taught[:40])
    assert features(none.of(rows[0][1]))[2:] == features(np.zeros(3, dtype=int))[2:]


def test_words_that_ordinary_text_nearly_spells():
    rng = random.Random(9)
    parts = ["an", "tel", "ro", "mi", "sed", "ur", "na", "vol", "ke", "st"]
    word = lambda n: "".join(rng.choice(parts) for _ in range(n))
    bad = [word(5) for _ in range(12)]
    texts, marks = [], []
    for i in range(1200):
        words = [word(rng.randint(1, 4)) for _ in range(rng.randint(20, 200))]
        for _ in range(2 * (i % 5 == 0)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        marks.append(int(i % 5 == 0))
    model = fit(texts[:800], marks[:800])
    gains = Gains(model.ordinary, model.toxic)
    z = [float(np.dot(features(gains.of(t)), model.weights)) for t in texts[800:]]
    said = [v >= 0.8473 for v in z]                                 # a score of 0.7
    right = sum(s and m for s, m in zip(said, marks[800:]))
    assert right >= 0.95 * sum(marks[800:]) and right >= 0.95 * sum(said)
