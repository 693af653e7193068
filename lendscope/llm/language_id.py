"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to 3 code points of the lower-cased text,
every run of other characters than letters one space), hashed into a fixed
number of buckets and weighted by TF-IDF (logarithmic counts, document
frequencies over all documents that may be learnt from, unit length).  The
weights are learnt by follow-the-regularised-leader, per coordinate, under an
elastic net, so most of them are exactly zero.  A temperature found on sample
rows that the weights have not seen turns the scores into probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BUCKETS = 1 << 15
LONGEST = 3                   # code points of an n-gram
PIECE = 1 << 20               # code points hashed at once, with overlap: bounds memory, never the text
FIT_ROWS = 4000               # bound of the labelled sample that weights and temperature are fitted on
CALIBRATION_SHARE = 5         # one in so many of its texts finds the temperature
EPOCHS = 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.1, 0.1
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
MIX = np.uint32(0x9E3779B1)   # odd multiplier that spreads a hash over its top bits
SHIFT = np.uint32(33 - BUCKETS.bit_length())


def letters(text: str | None) -> str:
    """Lower-cased words between single spaces; empty without a letter."""
    found = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {found} " if any(map(str.isalpha, found)) else ""


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of a normalised text."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, len(text), PIECE):
        part = text[start:start + PIECE + LONGEST - 1]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        h = np.zeros(len(code), dtype=np.uint32)
        found = []
        for n in range(1, min(LONGEST, len(code)) + 1):
            h = (h[:len(code) - n + 1] + code[n - 1:]) * MIX
            found.append(h[:PIECE] >> SHIFT)
        counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    """All that a prediction needs; its size is languages x buckets."""

    langs: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, dtype=np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + 1, 0), dtype=np.float32))
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, text: str) -> np.ndarray:
        at, counts = ngram_counts(text)
        return self.vector(at, counts) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = letters(text)
        if not found or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found) / self.temperature)
        best = int(p.argmax())                         # ties go to the language first in order
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for a softmax."""

    def __init__(self, features: int, classes: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        """The leader: closed form of the regularised sum of past gradients."""
        z = self.z[at]
        pull = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -pull / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = np.outer(x, p)
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def fit_temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of least weighted log loss (golden section on its logarithm)."""

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-(weight * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum())

    if not len(y):
        return 1.0
    a, b, r = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    c, d = b - r * (b - a), a + r * (b - a)
    lc, ld = loss(c), loss(d)
    for _ in range(50):
        if lc <= ld:
            b, d, ld = d, c, lc
            c = b - r * (b - a)
            lc = loss(c)
        else:
            a, c, lc = c, d, ld
            d = a + r * (b - a)
            ld = loss(d)
    return float(np.exp((a + b) / 2))


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, int]], idf: np.ndarray, totals: dict[str, int],
        epochs: int = EPOCHS, **penalties) -> Model:
    """Fit on rows (lang, buckets, counts, hash of the text).  ``totals`` are
    the documents of each language: the sample is balanced, so the ratio of
    the two corrects its priors.  Texts with hash 0 mod CALIBRATION_SHARE (all
    copies of a text alike) find the temperature, the others the weights."""
    langs = sorted({r[0] for r in rows})
    model = Model(langs=langs, idf=idf.astype(np.float32), weights=np.zeros((BUCKETS + 1, len(langs)), np.float32))
    if not langs:
        return model
    x = [(np.append(at, BUCKETS), np.append(model.vector(at, counts), 1.0)) for _, at, counts, _ in rows]
    y = np.array([langs.index(r[0]) for r in rows])
    aside = np.array([r[3] % CALIBRATION_SHARE == 0 for r in rows])
    if len(set(y[~aside])) < len(langs):
        aside[:] = False                               # too few rows to hold any back
    leader = Ftrl(BUCKETS + 1, len(langs), **penalties)
    learnt = np.flatnonzero(~aside)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(learnt).tolist():
            leader.learn(*x[i], int(y[i]))
    model.weights = leader.weights(slice(None)).astype(np.float32)
    ratio = np.array([totals[lang] for lang in langs]) / np.bincount(y, minlength=len(langs))
    model.weights[-1] += np.log(ratio)
    held = np.flatnonzero(aside)
    logits = np.array([x[i][1] @ model.weights[x[i][0]] for i in held]).reshape(len(held), len(langs))
    model.temperature = fit_temperature(logits, y[held], ratio[y[held]])
    return model


def held_out(id_col: str = "doc_id"):
    """True for the rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all rows, and their number."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(BUCKETS + 1, dtype=np.int64)
        for part in parts:
            for text in part["text"]:
                if found := letters(text):
                    held[ngram_counts(found)[0]] += 1
                    held[BUCKETS] += 1
        at = np.flatnonzero(held)
        yield pd.DataFrame({"bucket": at, "n": held[at]})

    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():          # at most BUCKETS + 1 rows
        out[r.bucket] = r.n
    return out[:BUCKETS], int(out[BUCKETS])


def fit_model(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on the rows that have an id, are not held out and have a language.

    Document frequencies and the totals of the languages cover all of them.
    Weights and temperature are fitted on at most ``fit_rows`` texts, dealt out
    to the languages in turn by the hash of the id, so a rare language has as
    many as a common one while it lasts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"), held_out().alias("held"))
    rows = rows.filter("id is not null and lang is not null and text is not null and not held").drop("held")
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    df, n = frequencies(rows)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = (rows.select("lang", "id").distinct().withColumn("turn", turn).filter(F.col("turn") <= fit_rows)
              .orderBy("turn", "lang").limit(fit_rows).drop("turn"))
    sample = rows.join(F.broadcast(chosen), ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))

    def vectors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for lang, text in zip(part["lang"], part["text"]):
                if found := letters(text):
                    at, counts = ngram_counts(found)
                    out.append((lang, at.astype(np.int32), counts.astype(np.int32), zlib.crc32(found.encode())))
            yield pd.DataFrame(out, columns=["lang", "buckets", "counts", "key"])

    found = sample.mapInPandas(vectors, "lang string, buckets array<int>, counts array<int>, key long").toPandas()
    found = [(r.lang, np.asarray(r.buckets, dtype=np.int64), np.asarray(r.counts, dtype=np.float64), int(r.key))
             for r in found.itertuples()]
    found.sort(key=lambda r: (r[0], r[3], r[1].tobytes(), r[2].tobytes()))
    return fit(found, np.log((1 + n) / (1 + df)) + 1, totals)


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A null text, an empty one and one without a letter are ``und`` with score
    0; so is every text if no row with a language may be learnt from.  A null
    id is never learnt from and not held out; repeated rows get a row each;
    texts are read whole; an empty table gives an empty result; other columns
    are not read.  Ties go to the language that sorts first.
    """
    model = fit_model(docs, fit_rows)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return (docs.select("doc_id", held_out().alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
