"""Toxicity by compression distance.

Two zstandard dictionaries are learnt, one from ordinary and one from toxic
text.  Every window of a text (the words that fill 12 bytes or more; each
window begins half-way into the one before) is compressed once against the
ordinary dictionary and once against toxic plus ordinary; the difference of
the two lengths says how much better toxic text explains the window.  The
ordinary dictionary lies nearer in both, so the toxic one is drawn on only for
what ordinary text does not explain as well.  The
windows of a text are counted at every step of that gain and a logistic curve,
fitted on labelled texts that the dictionaries have not seen, turns the counts
into a score.  Nothing but compression lengths and the number of windows
enters a score.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma
from math import log as log_

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 4000          # bound of the labelled sample the classifier is fitted on; its texts are whole
WINDOW_BYTES = 12
ORDINARY_BYTES = 64_000
TOXIC_BYTES = 32_768     # with the ordinary one well within the coder's window of 256 KB
PIECE_BYTES = 256        # whole texts are cut into samples of so many bytes for the dictionary trainer
SHARED = 5               # bytes in a row that a window must share with the toxic dictionary to gain by it
MIN_SUPPORT = 3          # toxic texts a word must occur in to be a sample of the toxic dictionary
CHANCE_WORDS = 0.5       # words that may pass for such by chance alone, expected number
STEPS = range(1, 9)      # gains (bytes) at which windows are counted
FOLDS = 5                # each is scored with dictionaries of the others
MEMO_ENTRIES = 200_000
TAIL = bytes([1, 2, 3, 4, 5, 6, 7, 8, 11])      # the coder starts no match in the last bytes of its input
CUT = 0.7


def spans(lengths: list[int], size: int = WINDOW_BYTES) -> Iterator[tuple[int, int]]:
    """(first, behind the last) word of runs of words of ``size`` bytes or more
    with their blanks (the last may be shorter), each from the middle of the
    one before, so that every word is in one at least."""
    i, n = 0, len(lengths)
    while i < n:
        j, held = i, 0
        while j < n and held < size:
            held += lengths[j] + 1
            j += 1
        yield i, j
        if j == n:
            return
        i += (j - i + 1) // 2


def bare(word: str) -> str:
    return word.strip(string.punctuation)


class Gains:
    """Bytes that the toxic dictionary saves on a window.

    A match in it costs the coder some four bytes, so a window that shares no
    ``SHARED`` bytes in a row with it has nothing to gain and is not compressed.
    """

    def __init__(self, ordinary: bytes, toxic: bytes):
        # A lead that both dictionaries hold: without it a short window is stored raw, and small gains are lost.
        self.lead = ordinary[-600:-552]
        self.plain = self.coder(ordinary)
        self.both = self.coder(toxic + ordinary)
        self.shared = np.unique(self.runs(toxic))
        self.may = np.zeros(1 << 20, dtype=bool)
        self.may[self.place(self.shared)] = True
        self.memo: dict[bytes, int] = {}

    @staticmethod
    def coder(content: bytes) -> zstd.ZstdCompressor:
        how = zstd.ZstdCompressionParameters(
            format=zstd.FORMAT_ZSTD1_MAGICLESS, compression_level=3, strategy=zstd.STRATEGY_BTLAZY2, min_match=3,
            window_log=18, hash_log=17, chain_log=18, search_log=5, target_length=64,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=how)
        return zstd.ZstdCompressor(dict_data=d, compression_params=how)

    @staticmethod
    def runs(data: bytes) -> np.ndarray:
        """Every ``SHARED`` bytes in a row, as a number each."""
        x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
        n = max(0, len(x) - SHARED + 1)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(SHARED):
            out = out << np.uint64(8) | x[k:k + n]
        return out

    @staticmethod
    def place(runs: np.ndarray) -> np.ndarray:
        return (runs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def gain(self, window: bytes) -> int:
        """Of a window with the blanks around it."""
        framed = self.lead + window + TAIL
        return len(self.plain.compress(framed)) - len(self.both.compress(framed))

    def of(self, text: str) -> np.ndarray:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        words = text.lower().encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, dtype=np.int64)
        data = b" " + b" ".join(words) + b" "
        lengths = [len(w) for w in words]
        end = np.cumsum(np.array(lengths) + 1)                  # place of the blank behind each word
        first, behind = np.array(list(spans(lengths))).T
        start, stop = end[first] - np.array(lengths)[first] - 1, end[behind - 1] + 1
        runs = self.runs(data)
        hits = np.flatnonzero(self.may[self.place(runs)])
        hits = hits[np.isin(runs[hits], self.shared)]
        out = np.zeros(len(start), dtype=np.int64)
        memo = self.memo
        for i in np.flatnonzero(np.searchsorted(hits, start) < np.searchsorted(hits, stop - SHARED, "right")).tolist():
            w = data[start[i]:stop[i]]
            g = memo.get(w)
            if g is None:
                g = memo[w] = self.gain(w)
            out[i] = g
        return out


def features(gains: np.ndarray) -> list[float]:
    """Windows at each step of the gain: their number, their share, and
    whether there are several; the best gain; the number of windows."""
    n = max(1, len(gains))
    at = [int((gains >= s).sum()) for s in STEPS]
    return [1.0, log_(n), float(max(0, gains.max())) if len(gains) else 0.0, *np.log1p(at), *np.sqrt(np.array(at) / n),
            *(float(k > 1) for k in at)]


@dataclass
class Model:
    """Everything scoring needs; its size is bounded by the dictionaries'."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] | None
    base: float


def _different(texts: list[str]) -> Iterator[set[str]]:
    """Words of the texts that are no near copies of an earlier one: a text is
    one if earlier texts hold half of its five-word shingles (of those, one in
    eight, by hash, is looked at).  Else the chance words of a text with many
    copies would pass for telling ones."""
    seen: set[int] = set()
    for text in dict.fromkeys(texts):
        words = text.lower().split()
        marks = {h for i in range(len(words) - 4)
                 if (h := zlib.crc32(" ".join(words[i:i + 5]).encode("utf-8", "surrogatepass"))) % 8 == 0}
        if marks and 2 * len(marks & seen) >= len(marks):
            continue
        seen |= marks
        yield {b for w in words if (b := bare(w))}


def _support(texts: list[str]) -> tuple[Counter, int]:
    """Different texts that hold each word, and their number."""
    count: Counter = Counter()
    kept = 0
    for words in _different(texts):
        count.update(words)
        kept += 1
    return count, kept


def _train(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; with too few samples to train on, their own bytes."""
    try:
        return zstd.train_dictionary(size, samples, level=3).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def tail(hits: int, texts: int, share: float) -> float:
    """Chance that ``hits`` or more of ``texts`` are toxic if toxic texts hold
    the window as often as any others do."""
    log = lgamma(texts + 1) - lgamma(hits + 1) - lgamma(texts - hits + 1)
    term = exp(log + hits * log_(share) + (texts - hits) * log_(1 - share))
    total = 0.0
    for k in range(hits, texts + 1):
        total += term
        if term < total * 1e-9:
            break
        term *= (texts - k) / (k + 1) * share / (1 - share)
    return total


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents.  The ordinary one is trained on
    whole ordinary texts.  The samples of the toxic one are the words that
    toxic texts hold far more often than ordinary texts do, as often as toxic
    texts hold them; the trainer may drop rare ones, so each follows once more,
    the most telling last."""
    (a, n_toxic), (b, n_ordinary) = _support(toxic), _support(ordinary)
    share = min(0.999, max(0.001, n_toxic / max(1, n_toxic + n_ordinary)))
    odds = [(tail(a[w], a[w] + b[w], share), w) for w in a if a[w] >= MIN_SUPPORT and a[w] > share * (a[w] + b[w])]
    telling = [w for p, w in sorted(odds, reverse=True) if p * len(odds) <= CHANCE_WORDS]
    whole = [t.lower().encode("utf-8", "surrogatepass") for t in ordinary]
    lead = _train(ORDINARY_BYTES, [t[i:i + PIECE_BYTES] for t in whole for i in range(0, len(t), PIECE_BYTES)])
    if len(lead) < 1024:
        lead = (lead + b" the of and in to a is that " * 64)[:2048]
    if not telling:
        return lead, b""
    samples = [f" {w} ".encode("utf-8", "surrogatepass") for w in telling]
    trained = _train(TOXIC_BYTES // 8, [s for w, s in zip(telling, samples) for _ in range(a[w])])
    return lead, (trained + b"".join(s[:-1] for s in samples) + b" ")[-TOXIC_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    lam = np.full(x.shape[1], ridge)
    lam[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + lam * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(lam) + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Fit on labelled texts.  Each fold is scored with dictionaries of the
    others, so the curve is fitted on texts that they have not seen; all copies
    of a text are in one fold."""
    y = np.array(toxic, dtype=float)
    base = float(y.mean()) if len(y) else 0.0
    split = lambda keep: ([t for t, v, k in zip(texts, toxic, keep) if k and v],
                          [t for t, v, k in zip(texts, toxic, keep) if k and not v])
    if len(y) == 0 or y.min() == y.max():
        return Model(b" " * 2048, b"", None, base)
    fold = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % FOLDS for t in texts])
    rows: list = [None] * len(texts)
    for f in range(FOLDS):
        if not (fold == f).any():
            continue
        gains = Gains(*dictionaries(*split(fold != f)))
        for i in np.flatnonzero(fold == f):
            rows[i] = features(gains.of(texts[i]))
    ordinary, bad = dictionaries(*split(np.ones(len(texts), dtype=bool)))
    return Model(ordinary, bad, _logistic(np.array(rows), y).tolist(), base)


def scorer(model: Model):
    """Column function: text -> score in 0..1."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gains = Gains(model.ordinary, model.toxic)
        for texts in parts:
            if model.weights is None:
                yield pd.Series(np.full(len(texts), model.base))
                continue
            x = np.array([features(gains.of(t or "")) for t in texts]).reshape(len(texts), len(model.weights))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))))

    return score


def held_out(id_col: str = "doc_id"):
    """True for the rows that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled rows that are not held out, taken
    by the hash of their id (the one bound: FIT_ROWS rows).  Labels without an
    id or a 0/1 mark are left out; an id marked more than once counts as toxic
    if any mark says so."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("id is not null and toxic in (0, 1)").filter(~held_out("id"))
             .groupBy("id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(fit_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sample = (texts.join(F.broadcast(marks), "id").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "text")
              .limit(fit_rows).collect())
    return fit([r.text for r in sample], [r.toxic for r in sample])


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored like any text without windows.  A null
    id is never learnt from and not held out.  Repeated rows keep a row each;
    an empty table gives an empty result; without labels of both kinds the
    score is the share of toxic labels (0 without any).  Only text enters a
    score.
    """
    model = fit_model(docs, labels, fit_rows)
    out = docs.select("doc_id", held_out().alias("held_out"),
                      scorer(model)(F.coalesce(F.col("text"), F.lit(""))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, cut: float = CUT) -> DataFrame:
    """The documents that score below ``cut``, all columns as they are."""
    model = fit_model(docs, labels, fit_rows)
    return docs.filter(scorer(model)(F.coalesce(docs["text"], F.lit(""))) < cut)
