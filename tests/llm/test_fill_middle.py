"""Fill-in-the-middle against a row-at-a-time version, and its round trip."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lendscope.llm import fill_middle as M

SCHEMA = "doc_id long, text string, output string, form int, h0 string"


def plain_version(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if doc_id is None:
        return None, n, "plain", None, None, text
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(11)
    odd = [None, "", "a", "é", "\n", "\0", "a\0b \r\n\x85 c", "a<P>b", "x <S> y", "<M>", "<", "<P", "<<S", "P>a<S S> <M",
           "日本語テキスト", "👩‍👩‍👧 fam", "ß" * 400, "word " * 60_000, "1234567890" * 20]
    return odd + ["".join(rng.choice("abZ <>PSM\n.é日\0") for _ in range(rng.randint(0, 80))) for _ in range(600)]


@pytest.mark.parametrize("most", [M.SLICE_BYTES, 50])
def test_equals_a_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(M, "SLICE_BYTES", most)
    rows = [(i, t, "x", i, "y") for i, t in enumerate(texts())] + [(None, "no id", "x", 1, None)] + [(7, "again a b", "", 0, "")] * 3
    out = M.fill_in_middle(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = out.withColumn("back", M.restored()).collect()
    want = sorted(map(str, (plain_version(r[0], r[1]) for r in rows)))
    assert sorted(str(tuple(r)[:-1]) for r in got) == want
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_own_shares(spark):
    assert M.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two, three").alias("text"))
    forms = dict(M.fill_in_middle(docs, plain_percent=50, spm_percent=50).groupBy("form").count().collect())
    assert abs(forms["plain"] - 1500) < 150 and abs(forms["psm"] - 750) < 120 and abs(forms["spm"] - 750) < 120
    assert M.fill_in_middle(docs, plain_percent=0).filter("form = 'plain'").count() == 0
