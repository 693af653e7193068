"""Personal data: seed entities against plain Python, discovery by context."""

import hashlib
import random
import re

from lendscope.llm.pii import find_pii

SCHEMA = "doc_id long, text string, kind string, row int, match string"
KINDS = ("email", "ip", "card", "phone")
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    text, out = text or "", []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or \
                    kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) or \
                    kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def expected(i, text):
    found = plain(text)
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    return (i, *(sum(x[0] == k for x in found) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base)


def texts():
    rng = random.Random(7)
    cards = ["4111111111111111", "4111 1111 1111 1111", "5500-0055-5555-5559", "4111111111111112", "6304000000000000000"]
    parts = [*cards, "a.b@c.de", "x@y@z.com", "a@b.com_x@c.de", "a@b", "@q.com", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
             "001.010.100.255", "0000255.1.1.1", "+1 (974) 555-3436", "+1 555", "+4912345678901234567", "++1 23456789--", " ", "  ", "\n",
             "-", ".", ",", "é", "😀", "\x01", "\x02", "7", "12", "x", "@", "+", "(", ")", "_", "%", "a@b.c.", "word", "9 9", "$0", "\\1"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(700)]
    return out + ["", "8" * 30_000, "a" * 30_000 + "@", "1." * 20_000, "+1" * 9_000, ("1.2.3.4 " * 3_000), "- " * 9_000 + "4111111111111111"]


def test_seed_entities_equal_plain_python(spark):
    rows = [(i, t, "k", 1, "m") for i, t in enumerate(texts())] + [(None, "a@b.de", "k", 1, "m"), (3, "a@b.de", None, None, None),
                                                                    (3, "a@b.de", None, None, None), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    out = find_pii(docs).collect()
    assert len(out) == len(rows)
    want = sorted(str(expected(i, t)[:-1]) for i, t, *_ in rows)
    assert sorted(str(tuple(r)[:-1]) for r in out) == want
    # discovered spans come on top of the seed entities and never overlap them
    for r in out:
        got.setdefault(r.doc_id, []).append(r.spans)
    for i, t, *_ in rows[:700]:
        spans = [x.split(":") for x in got[i][0].split(",") if x] if len(got[i]) == 1 else []
        base = {f"{k}:{a}:{b}" for k, a, b in plain(t)}
        if len(got[i]) == 1:
            assert base <= {":".join(x) for x in spans}
            for k, a, b in spans:
                assert f"{k}:{a}:{b}" in base or all(int(b) <= x or int(a) >= y for _, x, y in plain(t))


def test_context_finds_what_the_patterns_miss(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(60):
        rows.append((i, f"{word()} {word()} write to me at u{i}@{word()}.org or {word()} {word()}", "k", 1, "m"))
        rows.append((100 + i, f"{word()} please call the number +49 30 {1000000 + 37 * i} before {word()}", "k", 1, "m"))
    rows += [(300, "so write to me at bob7@localhost or go", "k", 1, "m"),
             (301, "é please call the number 555-1234567 before noon", "k", 1, "m"),
             (302, "in the year 1999-2005 we saw 123456789 things at home", "k", 1, "m"),
             (303, "please call the number 42 before noon", "k", 1, "m")]
    out = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[300].spans == "email:18:32" and out[300].n_email == 0
    assert out[301].spans == "phone:25:36" and out[301].n_phone == 0
    assert out[302].spans == out[303].spans == ""
    assert all(out[i].spans == expected(i, t)[-1] for i, t, *_ in rows[:120])


def test_empty_table(spark):
    assert find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_labels_between_random_words(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(60):
        rows.append((i, f"{word()} {word()} phone: +49 30 {1000000 + 37 * i} {word()} {word()}", "k", 1, "m"))
        rows.append((100 + i, f"{word()} {word()} mail u{i}@{word()}.org now {word()}", "k", 1, "m"))
        rows.append((200 + i, f"{word()} {word()} order {5000000 + 41 * i} {word()} {word()}", "k", 1, "m"))
    rows += [(300, "so much phone: 555-1234567 we said", "k", 1, "m"), (301, "they said mail bob7@localhost now or", "k", 1, "m"),
             (302, "they sent order 555-1234567 we said", "k", 1, "m")]
    out = {r.doc_id: r for r in find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[300].spans == "phone:15:26" and out[301].spans == "email:15:29" and out[302].spans == ""
    assert all(out[i].spans == expected(i, t)[-1] for i, t, *_ in rows[:180])
