"""Packing by power-of-two decomposition.

A document of n tokens becomes floor(n / 2048) pieces of 2048 tokens and one
piece for every binary digit of the rest, longest first.  A sequence is one
piece, so no sequence crosses documents and none needs padding; pieces of
equal length form a bucket (``bucket`` = log2 of the length) from which a
trainer draws batches.  The work is one pass over the documents: no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.bpe import WordIds

END_ID = 1
MAX_LENGTH = 2048


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: ``longest`` (a power of two) as
    often as it fits, then the binary digits of the rest from the top."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocab_path: str, longest: int = MAX_LENGTH, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit), doc_tokens, bucket, sequence_id, offset
    and, with ``with_ids``, the ids.

    Null text is empty; an empty text is the end id alone (one piece of one
    token).  Null ids stay null; repeated rows are packed each for itself; an
    empty table gives no pieces; other columns are not read.  ``sequence_id``
    follows the input's partitions and row order, so a task that is run again
    gives the same numbers.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocab_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for part in parts:
            rows: list[tuple] = []
            held: list[bytes] = []
            size = 0

            def flush():
                cols = list(zip(*rows)) or [[]] * 5
                arrays = [pa.array(c, type=pa.int64()) for c in cols]
                if with_ids:
                    flat = np.frombuffer(b"".join(held), dtype="<i4")
                    ends = np.concatenate(([0], np.cumsum(np.array(cols[2], dtype=np.int64)))).astype("i4")
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                return pa.RecordBatch.from_arrays(arrays, names=names)

            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = words.ids(text.as_py() or "") + end
                n, start = len(ids) // 4, 0
                for length in piece_lengths(n, longest):
                    piece = ids[4 * start: 4 * (start + length)]
                    rows.append((doc, start, length, zlib.crc32(piece), n))
                    if with_ids:
                        held.append(piece)
                    start += length
                size += len(ids)
                if size > 8_000_000:
                    yield flush()
                    rows, held, size = [], [], 0
            yield flush()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(cut, schema)
    return pieces.select("*", F.round(F.log2("length")).cast("int").alias("bucket"),
                         F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces as Parquet, one folder per bucket of equal lengths."""
    pieces.write.partitionBy("bucket").parquet(path)
