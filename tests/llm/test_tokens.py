"""Packing and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lendscope.llm.packing import pack, piece_lengths, write_buckets
from lendscope.llm.token_counts import count_tokens

SCHEMA = "doc_id long, text string, length int, sequence_id string"
ODD = ["", None, "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "  x  y\n\n z ", "\x1c a\x85b\xa0c　d",
       "don't we'll I'M x's", "日本語 テキスト 123٣٤", "ÀÉÎ İ ΣΑΣ ﬁ é", "a" * 5000, "1234567890 " * 3000,
       "\0a b\0 c", "a \0b", " \0", "\0 \0b \0b", "b \0b", "\t\ta\r\nb", "!!!???...   ---", " lead", "trail ", "👩‍👩‍👧 x‍"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab '\n\t .,1é\x1cß<|>S\0 ") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "null id", 2, None), (3, "again", None, "y"),
                                                             (3, "again", None, "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_token_counts_equal_the_library(docs):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = sorted(map(tuple, count_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect()), key=str)
    want = []
    for r in docs.collect():
        t = r.text or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        want.append((r.doc_id, len(t.encode()), n, n > 512))
    assert got == sorted(want, key=str)


def test_pieces_rebuild_every_document(docs):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = pack(docs, P.path("word_bpe_49k.json")).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    for r in out:
        assert r.offset == 0 and r.length == len(r.ids) == 1 << r.bucket and r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    want = sorted((str(r.doc_id), tuple(tok.encode(r.text or "", add_special_tokens=False).ids + [1]))
                  for r in docs.collect())
    built, held = [], {}
    for r in sorted(out, key=lambda r: r.sequence_id):      # a document's pieces follow one another
        if r.start == 0:
            held = []
            built.append((str(r.doc_id), held, r.doc_tokens))
        assert r.start == len(held)
        held.extend(r.ids)
    assert all(len(h) == n for _, h, n in built)
    assert sorted((d, tuple(h)) for d, h, _ in built) == want


def test_piece_lengths():
    assert piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    assert piece_lengths(1) == [1] and piece_lengths(2048) == [2048]


def test_empty_table_and_buckets(spark, docs, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert pack(empty, P.path("word_bpe_49k.json")).count() == 0
    assert count_tokens(empty, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    path = str(tmp_path / "buckets")
    write_buckets(pack(docs, P.path("word_bpe_49k.json")), path)
    back = spark.read.parquet(path)
    assert back.count() == pack(docs, P.path("word_bpe_49k.json")).count()
    assert back.filter("length != shiftleft(1, bucket)").count() == 0
