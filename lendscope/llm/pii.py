"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Fixed patterns find seed entities in every text.  The words around an entity
form lexical patterns; patterns and the identifier-like strings they meet make
a bipartite graph that is scored for some rounds: a pattern is as good as the
share of its strings that are entities of one kind, a string as good as its
best pattern.  Patterns of high confidence then mark strings that the fixed
patterns miss.

Positions come from marking every match with a control character, splitting
there and adding up the lengths of what lies before (a running sum per row, so
long rows cost no more than their length).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
MARK, STAND_IN = "\u0001", "\u0002"

#: The seed patterns.  Possessive quantifiers and the look-behinds leave the
#: leftmost non-overlapping matches as they are and keep the search linear;
#: the card pattern takes whole digit chains of 16 to 19 digits.
LOCAL = "A-Za-z0-9._%+-"
SEEDS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Identifier-like strings: digit groups, or runs of identifier characters
#: with a digit or an at sign, of five or more characters.
CANDIDATE = (r"(?<![0-9A-Za-z])\(?[0-9][\x20().0-9-]{5,}+(?<=[0-9])(?![0-9A-Za-z@])"
             r"|(?<![A-Za-z0-9._%+@:-])(?=[A-Za-z._%+:-]*+[0-9@])[A-Za-z0-9._%+@:-]{5,}+")
UNIT = r"([\p{L}\p{N}_]+|[^\s\p{L}\p{N}_])"
CONTEXT = 60              # characters on either side that the units of a pattern come from

ROUNDS = 3
MIN_SEEDS = 5             # distinct entities of its kind that an accepted pattern meets
MIN_SCORE = 0.6           # its share of entities
DAMPING = 0.9


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    d = F.reverse(_digits(match))
    digit = lambda i: F.substr(d, i, F.lit(1)).cast("int")
    twice = lambda i: 2 * digit(i) - F.when(digit(i) > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0),
                        lambda a, i: a + F.when(i % 2 == 0, twice(i)).otherwise(digit(i)))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    n = F.length(_digits(match))
    return (F.when(kind == "ip", match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(kind == "card", _luhn(match))
            .when(kind == "phone", n.between(8, 15)).otherwise(F.lit(True)))


def _plausible(kind: Column, text: Column) -> Column:
    """May a string that no seed pattern matches be of this kind at all?"""
    n = F.length(_digits(text))
    return (F.when(kind == "email", text.contains("@"))
            .when(kind == "ip", text.rlike("^[0-9a-fA-F]+(?:[.:]+[0-9a-fA-F]+){2,}$"))
            .when(kind == "card", n.between(12, 19)).otherwise(n.between(7, 15)))


def _marked(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, n, gap, match, left, right): a row per match, ``gap``
    the length of what lies between it and the match before."""
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK)

    def rows(p: Column) -> Column:
        places = F.when(F.size(p) > 1, F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))) \
            .otherwise(F.array().cast("array<int>"))
        before = lambda i: F.concat(F.coalesce(F.right(F.get(p, i - 2), F.lit(CONTEXT)), F.lit("")),
                                    F.right(F.get(p, i - 1), F.lit(CONTEXT)))
        behind = lambda i: F.concat(F.left(F.get(p, i + 1), F.lit(CONTEXT)),
                                    F.coalesce(F.left(F.get(p, i + 2), F.lit(CONTEXT)), F.lit("")))
        return F.transform(places, lambda i: F.struct(
            F.lit(kind).alias("kind"), i.alias("n"), F.length(F.get(p, i - 1)).cast("long").alias("gap"),
            F.get(p, i).alias("match"), F.right(before(i), F.lit(CONTEXT)).alias("left"),
            F.left(behind(i), F.lit(CONTEXT)).alias("right")))

    return F.flatten(F.transform(F.array(parts), rows))      # the split is computed once


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, kind, start, end, match, left, right) of every seed
    entity and candidate (kind "other"), code points, end exclusive; a row
    with null kind for every row of ``docs`` besides."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), MARK, STAND_IN)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
    none = _marked(F.lit(""), "", "x")
    digit = F.col("text").rlike("[0-9]")
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"), "ip": digit, "card": digit}
    found = [F.when(needs[k], _marked(F.col("text"), k, p)).otherwise(none) for k, p in SEEDS.items()]
    found.append(F.when(digit | needs["email"], _marked(F.col("text"), "other", CANDIDATE)).otherwise(none))
    itself = F.array(F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (
        ("kind", "string"), ("n", "int"), ("gap", "long"), ("match", "string"), ("left", "string"), ("right", "string"))]))
    hits = rows.select("row", "doc_id", F.explode(F.concat(itself, *found)).alias("hit")).select("row", "doc_id", "hit.*")
    so_far = W.partitionBy("row", "kind").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    core = F.rtrim(F.col("match"), F.lit(" ._%+@:-("))
    placed = hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    other = F.col("kind") == "other"
    placed = (placed.withColumn("end", F.when(other, F.col("start") + F.length(core)).otherwise(F.col("end")))
              .withColumn("match", F.when(other, core).otherwise(F.col("match"))))
    good = F.col("kind").isNull() | F.when(other, F.length("match") >= 5).otherwise(_valid(F.col("kind"), F.col("match")))
    return placed.filter(good).select("row", "doc_id", "kind", "start", "end", "match", "left", "right")


def _patterns() -> Column:
    """The lexical patterns of an occurrence: three, two and one units before
    it, two or one before and one behind, two behind.  The short ones need all
    their units."""
    units = lambda c: F.regexp_extract_all(F.regexp_replace(F.lower(c), "[0-9]", "0"), F.lit(UNIT), F.lit(1))

    def of(left: Column, right: Column) -> Column:
        last = lambda n: F.array_join(F.reverse(F.slice(left, 1, n)), " ")
        next_ = F.coalesce(F.get(right, F.lit(0)), F.lit(""))
        return F.array_compact(F.array(
            F.concat(F.lit("3 "), last(3)),
            F.concat(F.lit("2 "), last(2), F.lit(" _ "), next_),
            F.when(F.size(left) >= 2, F.concat(F.lit("2< "), last(2))),
            F.when(F.size(left) >= 1, F.concat(F.lit("1< "), last(1))),
            F.when((F.size(left) >= 1) & (F.size(right) >= 1), F.concat(F.lit("1 "), last(1), F.lit(" _ "), next_)),
            F.when(F.size(right) >= 2, F.concat(F.lit(">2 "), F.array_join(F.slice(right, 1, 2), " ")))))

    both = F.array(F.struct(F.reverse(units(F.col("left"))).alias("l"), units(F.col("right")).alias("r")))
    return F.flatten(F.transform(both, lambda x: of(x["l"], x["r"])))      # the units are computed once


def occurrences(spans: DataFrame) -> DataFrame:
    """(row, doc_id, start, end, match, kind, pattern): entities, and the
    candidates that overlap none, under each of their patterns."""
    base = F.col("kind") != "other"
    order = W.partitionBy("row").orderBy("start", F.when(base, 0).otherwise(1), "end")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    behind = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    seen = spans.filter("kind is not null").withColumn("before", before).withColumn("behind", behind)
    free = base | (F.coalesce(F.col("before") <= F.col("start"), F.lit(True))
                   & F.coalesce(F.col("behind") >= F.col("end"), F.lit(True)))
    return seen.filter(free).select("row", "doc_id", "start", "end", "match", "kind", F.explode(_patterns()).alias("pattern"))


def score_patterns(met: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score, seeds) of the pattern-instance graph.

    A pattern's score for a kind is the sum of its distinct strings' scores
    over their number plus one; an entity scores 1 for its kind, any other
    string DAMPING times its best pattern.
    """
    graph = materialize(met.groupBy("pattern", "match").agg(F.max(F.when(F.col("kind") != "other", F.col("kind"))).alias("kind")),
                        "pattern-graph")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    size = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = graph.filter("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    # Only patterns that meet an entity can ever score.
    live = materialize(graph.filter("kind is null").join(seeds.select("pattern").distinct(), "pattern", "left_semi")
                       .select("pattern", "match"), "open-graph")
    fixed = materialize(seeds.join(size, "pattern"), "pattern-seeds")
    score = fixed.select("pattern", "kind", "n", "seeds", (F.col("seeds") / (F.col("n") + 1)).alias("score"))
    for _ in range(rounds):
        strings = (live.join(score.select("pattern", "kind", "score"), "pattern")
                   .groupBy("match", "kind").agg((DAMPING * F.max("score")).alias("s")))
        gain = live.join(strings, "match").groupBy("pattern", "kind").agg(F.sum("s").alias("gain"))
        score = materialize(
            fixed.join(gain, ["pattern", "kind"], "left")
            .withColumn("score", (F.col("seeds") + F.coalesce("gain", F.lit(0.0))) / (F.col("n") + 1))
            .select("pattern", "kind", "n", "seeds", "score"), "pattern-scores")
    return score.select("pattern", "kind", "score", "seeds").filter(F.array_contains(kinds, F.col("kind")))


def discovered(met: DataFrame, scores: DataFrame, min_score: float = MIN_SCORE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(row, doc_id, kind, start, end): candidates under an accepted pattern,
    each with the kind of its best one."""
    sure = scores.filter((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds)).select("pattern", F.col("kind").alias("as"), "score")
    rank = reduce(lambda e, k: e.when(F.col("as") == k[1], k[0]), enumerate(KINDS), F)
    best = F.max(F.struct("score", (-rank).alias("first"), "as"))
    return (met.filter("kind = 'other'").join(sure, "pattern").filter(_plausible(F.col("as"), F.col("match")))
            .groupBy("row", "doc_id", "start", "end").agg(best.alias("best"))
            .select("row", "doc_id", F.col("best.as").alias("kind"), "start", "end"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (seed
    entities), base_sha256 (of their spans) and spans (these and the
    discovered ones), as kind:start:end by kind and start, joined by commas.

    Null text counts as empty: no spans.  Null ids and repeated rows are kept,
    one result each; an empty table gives an empty result; other columns are
    not read.  Discovered spans never overlap a seed entity.
    """
    spans = materialize(entities(docs, id_col, text_col), "entities")
    met = materialize(occurrences(spans), "occurrences")
    more = discovered(met, score_patterns(met, rounds))
    rank = reduce(lambda e, k: e.when(F.col("kind") == k[1], k[0]), enumerate(KINDS), F)
    every = (spans.filter("kind is null or kind != 'other'").select("row", "doc_id", "kind", "start", "end", F.lit(True).alias("base"))
             .unionByName(more.withColumn("base", F.lit(False))))
    item = F.struct(rank.alias("rank"), "start", "end", "kind")
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    known = F.col("kind").isNotNull()
    out = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(known & F.col("base"), item)).alias("seeds"),
        F.collect_list(F.when(known, item)).alias("all"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("seeds")), 256).alias("base_sha256"),
                      joined(F.col("all")).alias("spans"))
