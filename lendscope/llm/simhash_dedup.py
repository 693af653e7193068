"""SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are one row.  Fingerprints are laid into tiles by the
population counts of their equal parts: the distance of two fingerprints is at
least the sum of the differences of those counts, so tile pairs that differ by
more than the radius are skipped and every other pair is compared in full with
numpy exclusive-or and bit counts.  A tile pair yields at most a spanning
forest of its links; their components are found by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import materialize
from lendscope.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
TILE = 4096
#: More fingerprints, finer tiles: (up to so many fingerprints, parts).  Any
#: number of parts gives the same links; finer tiles skip more pairs and send
#: each fingerprint to more neighbours (13, 65 and 417 at radius 3).
PARTS = ((2_000_000, 2), (500_000_000, 4), (None, 8))

_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits set in over half of ``hashes``.  A table turns each byte
    into eight one-byte counters, which cannot overflow within 255 rows."""
    n = len(hashes)
    lanes = _LANES[hashes.astype("<u8").view(np.uint8).reshape(n, 8)]
    part = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0).astype("<u8")
    counts = part.view(np.uint8).reshape(len(part), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint, unsigned; 0 without words."""
    words = text.encode().lower().split()      # of bytes: A-Z alone, blanks \x20 and \x09-\x0D alone
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(line, SEED)
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle_words + 1].tolist()
    stops = (ends[shingle_words - 1:] - 1).tolist()
    return majority(np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp) per row; fp is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        bits = np.array([fingerprint(t or "", shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(bits.view(np.int64))

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       of(text).alias("fp"))


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links of at most ``radius`` bits between (or, if ``same``, within)
    unsigned arrays that together connect what any links connect."""
    n, m = len(a), len(b)
    label = np.arange(n if same else n + m)
    at_b = 0 if same else n
    out = []
    step = max(1, 1_000_000 // max(1, m))
    for i in range(0, n, step):
        near = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
        rows, cols = np.nonzero(near)
        rows = rows + i
        if same:
            rows, cols = rows[rows < cols], cols[rows < cols]
        while True:
            open_ = label[rows] != label[at_b + cols]
            rows, cols = rows[open_], cols[open_]
            if not len(rows):
                break
            _, first = np.unique(rows, return_index=True)     # one link of each row, then look again
            for r, c in zip(rows[first].tolist(), cols[first].tolist()):
                x, y = label[r], label[at_b + c]
                if x != y:
                    label[label == max(x, y)] = min(x, y)
                    out.append((int(a[r]), int(b[c])))
    return out


def half_offsets(parts: int, radius: int) -> list[int]:
    """Key differences of the tiles to look at: itself and one of each two
    opposite neighbours whose counts differ by ``radius`` in sum."""
    out = []

    def walk(left: int, lanes: list[int]):
        if len(lanes) == parts:
            lead = next((d for d in lanes if d), 0)
            if lead >= 0:
                out.append(sum(d << (8 * j) for j, d in enumerate(lanes)))
            return
        for d in range(-left, left + 1):
            walk(left - abs(d), [*lanes, d])

    walk(radius, [])
    return out


def links(prints: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints ``prints.fp`` that
    together connect all that are linked at ``max_bits`` or fewer."""
    if parts is None:
        n = prints.count()
        parts = next(p for most, p in PARTS if most is None or n <= most)
    width = 64 // parts
    lane = lambda j: F.bit_count(F.shiftrightunsigned("fp", width * j).bitwiseAND(F.lit((1 << width) - 1)))
    # A count and the radius stay clear of a lane's ends, so keys can be added.
    key = sum((F.shiftleft((lane(j) + max_bits + 1).cast("long"), 8 * j) for j in range(1, parts)),
              (lane(0) + max_bits + 1).cast("long"))
    keyed = prints.select("fp", key.alias("key"))
    sizes = materialize(keyed.groupBy("key").agg(F.ceil(F.count("*") / tile).alias("pieces")), "tile-sizes")
    cut = F.pmod(F.xxhash64("fp"), F.coalesce(F.col("pieces"), F.lit(1)))
    tiles = materialize(keyed.join(sizes.filter("pieces > 1"), "key", "left").select("key", cut.alias("piece"), "fp")
                        .groupBy("key", "piece").agg(F.collect_list("fp").alias("fps")), "tiles")
    # The pairs are listed without their fingerprints first, so that a pair and not a key is the unit of work.
    near = F.explode(F.array(*[F.lit(o).cast("long") for o in half_offsets(parts, max_bits)]))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    own = F.col("key") == F.col("key_a")
    listed = (tiles.select(F.col("key").alias("key_a"), F.col("piece").alias("piece_a"), near.alias("step"))
              .select("key_a", "piece_a", (F.col("key_a") + F.col("step")).alias("key"))
              .join(sizes, "key").select("key_a", "piece_a", "key", pieces.alias("piece"))
              .filter(~own | (F.col("piece_a") <= F.col("piece"))))
    pairs = (listed.join(tiles.withColumnRenamed("fps", "b"), ["key", "piece"])
             .join(tiles.select(F.col("key").alias("key_a"), F.col("piece").alias("piece_a"), F.col("fps").alias("a")),
                   ["key_a", "piece_a"])
             .select("a", "b", (own & (F.col("piece_a") == F.col("piece"))).alias("same")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = []
            for a, b, same in zip(part["a"], part["b"], part["same"]):
                found += forest(np.asarray(a, dtype=np.int64).view(np.uint64),
                                np.asarray(b, dtype=np.int64).view(np.uint64), bool(same), max_bits)
            yield pd.DataFrame(np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["u", "v"])

    return pairs.mapInPandas(compare, "u long, v long")


def grouped(prints: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(fp, root) of all linked fingerprints of ``prints`` (any rows with fp)."""
    return components(links(prints.select("fp").distinct(), max_bits, parts))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id that links reach (itself included).

    Null and blank texts have fingerprint zero and link like any other; a
    text shorter than a shingle is one shingle.  Null ids keep their row and
    never name a component (null if it holds no id at all).  Repeated rows
    keep a row each; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle_words), "fingerprints")
    of_print = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = grouped(of_print, max_bits, parts)
    member = of_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    label = member.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                         "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every near-duplicate group, all columns as they are:
    the one of smallest id (rows without id last), of equal ids the one of
    smallest text hash; of wholly equal such rows one."""
    rows = materialize(fingerprints(docs, shingle_words), "fingerprints")
    roots = grouped(rows, max_bits).withColumnRenamed("node", "fp")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = (first.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
              .agg(F.min("first").alias("first"))
              .select(F.col("first.doc_id").alias("_one_id"), F.col("first.text_key").alias("_one_key")))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    kept = docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(chosen["_one_id"])
                     & (key == chosen["_one_key"]))
    return kept.dropDuplicates(["_one_id", "_one_key"]).select(*[docs[c] for c in docs.columns])
