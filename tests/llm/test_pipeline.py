"""The whole pipeline on odd rows, planted cases and empty tables."""

import random

import corpus_pipeline
from lendscope.llm.packing import piece_lengths

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MARKS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"
BAD = ["grumbler", "blighter", "scoundrel"]


def write(spark, folder, docs, marks, items):
    for name, rows, schema in (("documents", docs, DOCS), ("labels", marks, MARKS), ("benchmark", items, ITEMS)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def text(rng, n=60):
    parts = ["an", "tel", "ro", "mi", "sed", "ur", "na", "vol", "ke", "st"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_planted_and_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    docs, marks = [], []
    for i in range(300):
        t = text(rng)
        if i % 6 == 0:
            words = t.split()
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            t = " ".join(words)
        docs.append((i, t, "en", f"s{i % 12}", len(t)))
        marks.append((i, 1, int(i % 6 == 0)))
    item = "which of the seven rivers of the old northern kingdom runs through the fewest towns before it meets the sea"
    copy, leak = docs[1][1], text(rng, 30) + " " + item
    docs += [(1000, copy, "en", "s1", 1), (1001, leak, "en", "s2", 1), (1002, None, None, None, None), (1003, "", "", "", 0),
             (None, text(rng), "en", "s3", 1), docs[7], docs[7]]
    line = "all rights reserved by the owners of this very page"
    docs += [(2000 + k, f"{line}\n{text(rng)}", "en", f"site{k}", 1) for k in range(12)]
    folder = write(spark, str(tmp_path), docs, marks, [(1, item), (2, None)])
    pieces = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in pieces}
    toxic = {i for i in range(300) if i % 6 == 0}
    assert len(kept & toxic) <= 2                        # nearly all toxic documents went
    assert len(kept & set(range(300)) - toxic) >= 245    # clean ones stayed
    assert 1 in kept and 1000 not in kept and 1001 not in kept and None in kept
    assert {2000 + k for k in range(12)} <= kept
    first = [r for r in pieces if r.doc_id == 7 and r.start == 0]
    assert len(first) == 1                               # rows that repeat are one document of their group
    for d in kept:
        mine = sorted((r.start, r.length, r.doc_tokens) for r in pieces if r.doc_id == d)
        assert [m[1] for m in mine] == piece_lengths(mine[0][2])
    blank = [r for r in pieces if r.doc_id in (1002, 1003)]
    assert len(blank) == 1 and blank[0].length == 1      # null and empty texts are copies of each other


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, str(tmp_path / "a"), [], [], [])).count() == 0
    docs = [(1, "some words of a text", "en", "s", 20)]
    out = corpus_pipeline.run(spark, write(spark, str(tmp_path / "b"), docs, [], [])).collect()
    assert {r.doc_id for r in out} == {1}


def test_stages_keep_the_columns(spark, tmp_path):
    rng = random.Random(3)
    folder = write(spark, str(tmp_path), [(i, text(rng), "en", "s", 1) for i in range(5)], [(1, 1, 0)], [(1, "a b c d e f")])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
