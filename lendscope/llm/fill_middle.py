"""Fill-in-the-middle transformation as a pyarrow.compute pipeline.

A text is cut into units (a run of ASCII letters, or any other single code
point); two random cuts split it into prefix, middle and suffix, and the three
are written in the order a fill-in-the-middle model reads: prefix, suffix,
middle (psm) or suffix, prefix, middle (spm).  All units of a slice of rows are
one flat array: parent indices say whose they are, ordinals where they stand,
three filters take the roles apart, offsets rebuild the lists and
``binary_join`` the pieces.  No Python loop runs over rows or units.

The draws are hashes of the row's id, so a task that is run again gives the
same output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The markers of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One unit of UTF-8 bytes, and a byte that UTF-8 never holds to end each.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
END = b"\xff"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SLICE_BYTES = 2_000_000       # text worked on at once: bounds memory, never the rows


def draws(id_col: str = "doc_id", seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit draws from the row's id (null for a null id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def modulo(x: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def transform(text: pa.Array, h: list[pa.Array], plain_percent: int = PLAIN_PERCENT,
              spm_percent: int = SPM_PERCENT) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a slice of texts."""
    raw = text.cast(pa.large_binary())
    units = pc.split_pattern(pc.replace_substring_regex(raw, pattern=UNIT, replacement=b"\\1" + END), pattern=END)
    size = pc.subtract(pc.list_value_length(units).cast(pa.int64()), 1)       # every unit ends, so an empty one follows
    one_more = pc.add(size, 1)
    a, b = modulo(h[0], one_more), modulo(h[1], one_more)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    marked = pc.match_substring_regex(text, pattern=f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    plain = pc.fill_null(pc.or_kleene(pc.or_(pc.equal(size, 0), marked),
                                      pc.greater_equal(modulo(h[2], 100), 100 - plain_percent)), True)
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(modulo(h[3], 100), spm_percent), "spm", "psm"))

    parent = pc.list_parent_indices(units)
    flat = pc.list_flatten(units)
    first = pc.take(units.offsets.cast(pa.int64()), parent)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.subtract(first, units.offsets[0].as_py()))
    before = pc.less(ordinal, pc.take(low, parent))
    inside = pc.and_(pc.invert(before), pc.less(ordinal, pc.take(high, parent)))

    none, *marks = [pa.scalar(m.encode(), pa.large_binary()) for m in ("", PREFIX, SUFFIX, MIDDLE)]

    def piece(role: pa.Array, counts: pa.Array) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum(pc.fill_null(counts, 0).to_numpy(zero_copy_only=False))))
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), pc.filter(flat, pc.fill_null(role, False)))
        return pc.binary_join(lists, none)

    prefix = piece(before, low)
    middle = piece(inside, pc.subtract(high, low))
    suffix = piece(pc.invert(pc.or_(before, inside)), pc.subtract(one_more, high))
    psm = pc.binary_join_element_wise(marks[0], prefix, marks[1], suffix, marks[2], middle, none)
    spm = pc.binary_join_element_wise(marks[1], suffix, marks[0], prefix, marks[2], middle, none)
    out = pc.if_else(plain, raw, pc.if_else(pc.equal(form, "spm"), spm, psm)).cast(pa.large_string())
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()),
                        pc.utf8_length(p.cast(pa.large_string())).cast(pa.int64())) for p in (prefix, middle)]
    return [size, form, *chars, out]


def slices(part: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text; a longer text is a run of its own."""
    bytes_ = pc.fill_null(pc.binary_length(part.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(bytes_) - bytes_) // most
    edges = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [len(run)]))
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield part.slice(a, b - a)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm),
    prefix_chars and middle_chars (code points; null if plain) and output.

    Null text is empty; empty texts, texts that hold a marker and rows without
    an id (they have no draw) are plain, with the text itself as output.
    Repeated rows get equal outputs, an empty table gives an empty result,
    very long texts are worked on whole, other columns are not read.  One pass
    over the documents: no shuffle.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for s in slices(part, 1):
                cols = transform(s.column(1), [s.column(2 + k) for k in range(4)], plain_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([s.column(0)] + [c.cast(f.type) for c, f in zip(cols, fields)],
                                                 names=["doc_id"] + [f.name for f in fields])

    fields = [pa.field("n", pa.int64()), pa.field("form", pa.string()), pa.field("prefix_chars", pa.int64()),
              pa.field("middle_chars", pa.int64()), pa.field("output", pa.string())]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *[d.alias(f"h{k}") for k, d in enumerate(draws(id_col, seed))])
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text from output and form.  No piece holds a marker and no
    marker overlaps itself, so splitting at the three markers is exact."""
    p = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (F.when(F.col(form) == "plain", F.col(output))
            .when(F.col(form) == "psm", F.concat(p[1], p[3], p[2]))
            .otherwise(F.concat(p[2], p[3], p[1])))
