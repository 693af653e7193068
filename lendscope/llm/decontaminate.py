"""Benchmark decontamination by template canonicalisation.

Numbers, names (capitalised words) and units (a unit word after a number)
become typed placeholders; five-token windows of the templates are hashed and
joined with the benchmark's windows.  Along every alignment of a document with
an item the placeholders' values must correspond: the same item value always
meets the same document value.  Every window has a second, case-folded hash in
which names are plain words, so a copy in other case is met too; a window that
only its case keeps from the template and that is word for word the item's is
held even if its alignment's values do not correspond.  An item leaks into a
document that holds 0.8 or more of its windows that way, so copies with other
numbers, names or units are caught as well as plain ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

WINDOW = 5
SHARE = 0.8
MIN_LITERALS = 2          # a window with fewer plain words keeps its values in place of placeholders
BITMAP_BITS = 1 << 23     # filter of the benchmark's windows that every task holds (1 MB)
MEMO_ENTRIES = 200_000

SHORTEST_PASSAGE = 3      # an item of fewer tokens names no passage: it is met by documents that are the item
#: Blocks of scripts written without blanks (Thai to Burmese, Khmer, kana, Han); a code point is a token.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN = re.compile(rf"\d+(?:[.,:/]\d+)*|[{UNSPACED}]|[^\W\d_{UNSPACED}]+(?:['’][^\W\d_{UNSPACED}]+)*|[%$€£]")
RUN_TOKENS = 200_000      # tokens hashed at once: bounds memory, never the text
MEMO_CHARS = 64           # a longer piece between blanks is not kept
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion""".split())
UNITS = frozenset("""% $ € £ mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram
kilograms ounce ounces oz pound pounds lb ton tons ml l liter liters litre litres gallon gallons second seconds s
minute minutes min hour hours h day days week weeks month months year years cent cents dollar dollars euro euros
degree degrees meter meters metre metres percent mph watt watts volt volts byte bytes kb mb gb""".split())

LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
_PLACEHOLDER = np.array([0, 0x1111, 0x2222, 0x3333], dtype=np.uint64)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def kind(token: str) -> int:
    if token.islower():                        # most tokens
        return NUMBER if token in NUMBER_WORDS else LITERAL
    if token[0].isdigit() or token.lower() in NUMBER_WORDS:
        return NUMBER
    if token[0].isupper() and (len(token) == 1 or token[1:].islower()):
        return NAME
    return LITERAL


def token_id(token: str) -> int:
    """62 bits of the case-folded token and its kind."""
    return xxhash.xxh64_intdigest(token.casefold()) & ~3 | kind(token)


UNIT_IDS = np.array(sorted({token_id(u) for u in UNITS} | {token_id(u.capitalize()) for u in UNITS}), dtype=np.uint64)


def _hash(columns: np.ndarray, at: np.ndarray | slice, window: int, seed: int, first: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows that begin ``at`` those places; ``first`` stands
    for ``columns`` at a window's first token."""
    h = np.uint64(seed)
    for k in range(window):
        here = columns if k or first is None else first
        h = (h ^ (here[k + at.start:k + at.stop] if isinstance(at, slice) else here[k + at])) * _MULT
        h ^= h >> np.uint64(31)
    return h


class Pieces(dict):
    """Token ids (8 bytes each) of pieces between blanks, made when first met."""

    def __missing__(self, piece: str) -> bytes:
        ids = b"".join([token_id(t).to_bytes(8, "little") for t in TOKEN.findall(piece)])
        if len(piece) <= MEMO_CHARS:
            self[piece] = ids
        return ids


class Templates:
    """Window hashes of texts; pieces between blanks are memoised."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.memo = Pieces()

    def ids(self, text: str) -> np.ndarray:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        return np.frombuffer(b"".join(map(self.memo.__getitem__, text.split())), dtype="<u8")

    def windows(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template and folded hash per window, kind per token, whether a
        window has placeholders under either).  A folded hash depends on its
        own window alone: a unit is one only behind a number of the window."""
        return self.cut(self.ids(text), self.window)

    def cut(self, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(ids) - window + 1
        kinds = (ids & np.uint64(3)).astype(np.int64)
        after = np.flatnonzero(kinds[:-1] == NUMBER) + 1
        if len(after):
            kinds[after[np.isin(ids[after], UNIT_IDS)]] = UNIT
        if n <= 0:
            return np.zeros((2, 0), dtype=np.uint64), kinds, np.zeros((2, 0), dtype=bool)
        enough = lambda plain: plain[window:] - plain[:-window]
        seed = 16 * (self.window - window)                    # windows of different lengths do not meet
        word = (kinds == LITERAL) | (kinds == NAME)
        typed = enough(np.concatenate(([0], np.cumsum(kinds == LITERAL)))) >= MIN_LITERALS
        folded = enough(np.concatenate(([0], np.cumsum(word)))) + (kinds[:n] == UNIT) >= MIN_LITERALS
        exact, every = ids >> np.uint64(2), slice(0, n)
        h = np.empty((2, n), dtype=np.uint64)
        h[0] = _hash(np.where(kinds == LITERAL, ids, _PLACEHOLDER[kinds]), every, window, seed + 1)
        h[1] = _hash(np.where(word, exact, _PLACEHOLDER[kinds]), every, window, seed + 3,
                     np.where(kinds == NUMBER, _PLACEHOLDER[NUMBER], exact))
        for f, template in enumerate((typed, folded)):
            few = np.flatnonzero(~template)
            if len(few):
                h[f, few] = _hash(exact, few, window, seed + 2 + 2 * f)
        return h, kinds, np.array([typed, folded])

    @staticmethod
    def slots(tokens: list[str], kinds: np.ndarray, at: int, folded: bool, template: bool, window: int) -> list[str]:
        if not template:
            return []
        values = (NUMBER, UNIT) if folded else (NUMBER, NAME, UNIT)
        return [tokens[at + k].casefold() for k in range(window)
                if kinds[at + k] in values and not (folded and k == 0 and kinds[at] == UNIT)]


def _tokens(text: str) -> list[str]:
    return [t for p in text.split() for t in TOKEN.findall(p)]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, item_key, item_pos, folded, h, item_slots, n_windows, size), a
    row per window of ``size`` tokens with its template's hash and one with its
    folded hash.  The whole of a shorter item is its one window."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Templates(window)
        for part in parts:
            rows = []
            for item, key, text in zip(part["item_id"], part["item_key"], part["text"]):
                ids = make.ids(text)
                if not len(ids):
                    continue
                size = min(window, len(ids))
                h, kinds, template = make.cut(ids, size)
                tokens = _tokens(text)
                rows += [(item, key, i, bool(f), v, make.slots(tokens, kinds, i, f, template[f, i], size), h.shape[1], size)
                         for f in (0, 1) for i, v in enumerate(h[f].view(np.int64).tolist())]
            out = pd.DataFrame(rows, columns=["item_id", "item_key", "item_pos", "folded", "h", "item_slots", "n_windows", "size"])
            yield out.astype({"item_id": "Int64"})

    items = benchmark.filter("text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_key"), "text").distinct()
    return items.mapInPandas(cut, "item_id long, item_key long, item_pos int, folded boolean, h long, "
                                  "item_slots array<string>, n_windows int, size int")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bits at two places of every benchmark window: BITMAP_BITS in all,
    whatever the benchmark's size."""
    mask = F.lit(BITMAP_BITS - 1)
    place = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask)))
    words = (windows.select(place.alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect())
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for r in words:
        out[r.word] = r.bits
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def runs(ids: Iterator[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts' token ids laid end to end, about ``RUN_TOKENS`` at a time (a
    longer text is a run of its own), an id that no token has behind each:
    (first text, ids, where each text starts, its number of tokens)."""
    at, held, size = 0, [], 0

    def laid():
        count = np.array([len(x) for x in held])
        flat = np.zeros(int(count.sum()) + len(held), dtype="<u8")
        start = np.concatenate(([0], np.cumsum(count + 1)[:-1]))
        for s, x in zip(start.tolist(), held):
            flat[s:s + len(x)] = x
        return at, flat, start, count

    for x in ids:
        if held and size + len(x) > RUN_TOKENS:
            yield laid()
            at, held, size = at + len(held), [], 0
        held.append(x)
        size += len(x)
    if held:
        yield laid()


def document_windows(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, text_key, doc_pos, h, doc_slots) of the windows of those sizes
    that may be the benchmark's; the bitmap only saves work, the join decides."""
    packed = np.packbits(bitmap)

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, bits = Templates(max(sizes)), np.unpackbits(packed).astype(bool)
        mask = np.uint64(len(bits) - 1)
        for part in parts:
            rows = []
            doc, key, text = (part[c].tolist() for c in ("doc_id", "text_key", "text"))
            for at, flat, start, count in runs(make.ids(t) for t in text):
                for size in sizes:
                    h, kinds, template = make.cut(flat, size)
                    may = bits[h & mask]
                    may &= bits[(h >> np.uint64(32)) & mask]
                    held, place = np.nonzero(may)
                    which = np.searchsorted(start, place, "right") - 1
                    fits = place - start[which] + size <= count[which]          # within one text
                    if size < SHORTEST_PASSAGE:
                        fits &= count[which] == size
                    tokens: dict[int, list[str]] = {}
                    for f, i, w in zip(held[fits].tolist(), place[fits].tolist(), which[fits].tolist()):
                        if w not in tokens:
                            tokens = {w: _tokens(text[at + w])}
                        first = i - int(start[w])
                        slots = make.slots(tokens[w], kinds[start[w]:start[w] + count[w]], first, f, template[f, i], size)
                        rows.append((doc[at + w], key[at + w], first, int(h[f, i].view(np.int64)), slots))
            out = pd.DataFrame(rows, columns=["doc_id", "text_key", "doc_pos", "h", "doc_slots"])
            yield out.astype({"doc_id": "Int64"})

    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                   F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInPandas(cut, "doc_id long, text_key long, doc_pos int, h long, doc_slots array<string>")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, n_matched) of every document and
    item of which it holds ``share`` or more of the windows.

    The one window of an item shorter than ``window`` tokens is the whole item;
    an item of one or two tokens leaks only into a document that is nothing
    else.  In scripts written without blanks every code point is a token.  Null
    texts and texts without a token hold nothing and leak nowhere.  Ids may be null or repeat: rows
    are told apart by id and text, wholly equal rows give one result.  Either
    table may be empty; other columns are not read.
    """
    items = materialize(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = sorted({r["size"] for r in items.select("size").distinct().collect()} | {window}, reverse=True)
    held = document_windows(docs, _bitmap(items), sizes)
    met = held.join(items, "h").select(
        "doc_id", "text_key", "item_id", "item_key", "n_windows", "item_pos", "folded",
        (F.col("folded") & (F.col("item_slots") == F.col("doc_slots"))).alias("same"),
        (F.col("doc_pos") - F.col("item_pos")).alias("shift"),
        F.arrays_zip(F.col("item_slots").alias("i"), F.col("doc_slots").alias("d")).alias("slots"))
    pair = ["doc_id", "text_key", "item_id", "item_key", "n_windows"]
    values = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    aligned = met.groupBy(*pair, "shift").agg(
        F.collect_set("item_pos").alias("pos"), values("slots").alias("slots"),
        F.collect_set(F.when(~F.col("folded"), F.col("item_pos"))).alias("typed"),
        values(F.when(~F.col("folded"), F.col("slots"))).alias("typed_slots"),
        F.collect_set(F.when(F.col("same"), F.col("item_pos"))).alias("same"))
    one_value = lambda c: F.size(c) == F.size(F.array_distinct(F.transform(c, lambda s: s["i"])))
    held_pos = (F.when(one_value("slots"), F.col("pos"))
                .when(one_value("typed_slots"), F.array_union("typed", "same")).otherwise(F.array_except("same", "typed")))
    return (aligned.withColumn("pos", held_pos).groupBy(*pair)
            .agg(F.size(F.array_distinct(F.flatten(F.collect_list("pos")))).alias("n_matched"))
            .filter(F.col("n_matched") >= F.col("n_windows") * share)
            .select("doc_id", "text_key", "item_id", F.col("n_windows").cast("long").alias("n_windows"),
                    F.col("n_matched").cast("long").alias("n_matched")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The documents that no item leaks into, all columns as they are."""
    bad = materialize(leaks(docs, benchmark, window, share)
                      .select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct(),
                      "leaks")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_leak_id"])
                     & (F.xxhash64(docs["text"]) == bad["_leak_key"]), "left_anti")
