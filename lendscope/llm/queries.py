"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lendscope.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_binary_packing")
def q_packing(spark, sf_dir):
    from lendscope.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@register("op10_rank_merge_token_counts")
def q_token_counts(spark, sf_dir):
    from lendscope.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.PATTERN)


@register("op2_compression_toxicity")
def q_toxicity(spark, sf_dir):
    from lendscope.llm.toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_line_site_spread")
def q_line_dedup(spark, sf_dir):
    from lendscope.llm.line_dedup import remove_boilerplate
    out = remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("_n_gone").alias("n_removed"))


ORACLES["op4_line_site_spread"] = """
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents),
boilerplate AS (
    SELECT trim(line, ' ') AS body, min(doc_id) AS keeper
    FROM lines WHERE trim(line, ' ') <> ''
    GROUP BY 1 HAVING count(DISTINCT source) >= 10),
marked AS (
    SELECT l.doc_id, l.line, l.pos, (b.keeper IS NOT NULL AND b.keeper <> l.doc_id) AS gone
    FROM lines l LEFT JOIN boilerplate b ON trim(l.line, ' ') = b.body)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed
FROM marked GROUP BY doc_id
"""


@register("op5_simhash_tiles")
def q_simhash(spark, sf_dir):
    from lendscope.llm.simhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_template_leaks")
def q_leaks(spark, sf_dir):
    from lendscope.llm.decontaminate import leaks
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@register("op3_mincut_html_text")
def q_html(spark, sf_dir):
    from lendscope.llm.html_mincut import extract
    return extract(table(spark, sf_dir, "pages"))


@register("op7_warc_round_trip")
def q_warc(spark, sf_dir):
    from lendscope.llm.warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


ORACLES["op7_warc_round_trip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                     ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM f
"""


@register("op8_adaptive_scan_neighbours")
def q_neighbours(spark, sf_dir):
    from lendscope.llm.ann import search
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op9_bootstrapped_pii")
def q_pii(spark, sf_dir):
    from lendscope.llm.pii import find_pii
    return find_pii(table(spark, sf_dir, "documents"))


@register("op11_arrow_fill_in_middle")
def q_fill_in_middle(spark, sf_dir):
    from lendscope.llm.fill_middle import fill_in_middle, restored
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


ORACLES["op11_arrow_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
             [CAST('0x' || substr(h, 1 + 8 * k, 8) AS BIGINT) for k in [0, 1, 2, 3]] AS r FROM d),
c AS (SELECT *, len(units) AS n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS lo,
             greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS hi FROM u),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90
                     THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(units[1:lo], '') AS p, array_to_string(units[lo + 1:hi], '') AS m,
             array_to_string(units[hi + 1:n], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""


@register("op13_filter_interactions")
def q_filter_audit(spark, sf_dir):
    from lendscope.llm.filter_audit import filter_audit
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_interactions"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w
    FROM documents),
f AS (
    SELECT d.doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS dd,
           coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e,
           coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
    FROM d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
                      FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id),
g AS (
    SELECT part, [a, b, c, dd, e] AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
           count(*) FILTER (WHERE toxic) AS toxic
    FROM f GROUP BY 1, 2),
parts AS (SELECT DISTINCT part FROM g),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, i AS step FROM o, l),
r AS (
    SELECT g.*, s.o, s.step, fails[o[step]] AS now, list_bool_or([fails[x] for x in o[1:step - 1]]) AS earlier
    FROM g, s),
x AS (
    SELECT part, o, step,
           sum(n) FILTER (WHERE NOT now AND NOT coalesce(earlier, false)) AS kept,
           sum(n) FILTER (WHERE now AND NOT coalesce(earlier, false)) AS removed,
           sum(n) FILTER (WHERE now AND coalesce(earlier, false)) AS redundant,
           sum(n) FILTER (WHERE now AND len([y for y in fails if y]) = 1) AS unique_fails,
           sum(good) FILTER (WHERE now AND NOT coalesce(earlier, false)) AS good_lost,
           sum(toxic) FILTER (WHERE now AND NOT coalesce(earlier, false)) AS toxic_lost
    FROM r GROUP BY 1, 2, 3)
SELECT part, array_to_string([substr('ABCDE', i, 1) for i in o], '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM x
"""


@register("op12_ftrl_language_id")
def q_language(spark, sf_dir):
    from lendscope.llm.language_id import identify
    return identify(table(spark, sf_dir, "documents"))
