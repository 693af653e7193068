"""Line dedup against a plain Python version."""

import random
from collections import defaultdict

from lendscope.llm.line_dedup import boilerplate_lines, dedup_lines, remove_boilerplate

SCHEMA = "doc_id long, text string, source string, n_chars long, keeper string, pos int"


def brute(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for i, t, s, *_ in rows:
        for line in (t or "").split("\n"):
            k = line.strip(" ")
            if k:
                sites[k] |= {s} - {None}
                if i is not None:
                    keeper[k] = min(keeper.get(k, i), i)
    out = []
    for i, t, s, n, *rest in rows:
        if t is not None:
            kept = [x for x in t.split("\n")
                    if not (len(sites[x.strip(" ")]) >= min_sites and x.strip(" ") in keeper
                            and keeper[x.strip(" ")] != i)]
            if len(kept) < len(t.split("\n")):
                t = "\n".join(kept)
                n = len(t)
        out.append((i, t, s, n, *rest))
    return sorted(out, key=str)


def rows_of(seed=1):
    rng = random.Random(seed)
    common = [f"shared line {k}" for k in range(12)]
    rows = []
    for i in range(300):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"own {i} {j}" for j in range(rng.randint(0, 8))]
        # each shared line k lives on about 4 + k sites
        lines = [x for x in lines if not x.startswith("shared") or i % 20 < 4 + int(x.split()[-1])]
        text = "\n".join(("  " + x if rng.random() < 0.2 else x) for x in lines)
        rows.append((i, text, f"s{i % 20}", len(text), "k", 1))
    rows += [(None, "shared line 11\nx", "s1", 16, None, None), (None, "shared line 11", "s2", 14, None, None),
             (900, None, "s3", None, None, 2), (901, "", None, 0, "", 3), (902, "shared line 11\n\nown", None, 19, "", 3),
             rows[0], rows[0], rows[41],
             (903, "\n".join(["shared line 11"] * 30_000 + ["tail"]), "s4", 0, "", 3)]
    for i in range(950, 965):                     # a line that only rows without id hold
        rows.append((None, "nobody", f"s{i}", 6, None, None))
    return rows


def test_same_as_brute_force_and_near_threshold_is_exact(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for min_sites in (6, 10, 14):
        assert sorted(map(tuple, dedup_lines(docs, min_sites).collect()), key=str) == brute(rows, min_sites)


def test_removed_counts_and_columns(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = remove_boilerplate(docs)
    assert out.columns == docs.columns + ["_n_gone"]
    assert out.filter("_n_gone = 0").count() + out.filter("_n_gone > 0").count() == len(rows)
    assert out.filter("doc_id = 903").first()["_n_gone"] == 30_000


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert dedup_lines(docs).count() == 0 and boilerplate_lines(docs).count() == 0


def test_columns_named_like_the_helpers(spark):
    clash = SCHEMA.replace("keeper", "_gone").replace("pos", "_n_gone") + ", doc int, text_key int, removed int, `__n_gone` int"
    rows = [(i, f"same line\nown {i}", f"s{i}", 5, "x", 1, 2, 3, 4, 5) for i in range(12)] + [(None, None, None, None) + (None,) * 6]
    docs = spark.createDataFrame(rows, clash)
    out = dedup_lines(docs)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == (
        {(0, "same line\nown 0"), (None, None)} | {(i, f"own {i}") for i in range(1, 12)})
    assert remove_boilerplate(docs).columns == docs.columns + ["___n_gone"]
