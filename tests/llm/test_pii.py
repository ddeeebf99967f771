"""Personal data against Python's regular expressions, and what contexts give away."""

import random
import re
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from labelloom.llm import pii

KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return sorted(
        (m.start(), n, m.end())
        for n, (kind, pattern) in enumerate(KINDS)
        for m in pattern.finditer(text or "")
        if good(kind, m.group())
    )


def spans(value):
    return sorted((s["start"], s["kind"], s["end"]) for s in value)


def texts():
    draw = random.Random(4)
    parts = [
        "a", "b9", "@", ".", "-", "_", "1.2.3.4", "300.1.1.1", "+1 (499) 555-6503", " ", "x@y.z",
        "4111 1111 1111 1111", "é🙂", "\n", "0", "12", "%", "+",
    ]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(800)]
    long_ones = ["1" * 20_000, "a" * 20_000 + "@b" + ".c" * 10_000, "1.1." * 2000, "+1" + " " * 9000, "x@y.z " * 1500]
    return [*made, *long_ones, None, ""]


def test_base_spans(spark):
    rows = list(enumerate(texts()))
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = {i: base(t) for i, t in rows}
    assert {r["doc_id"]: spans(r["base"]) for r in got.collect()} == want


def test_awkward_rows(spark):
    got = pii.find_personal_data(cases.frame(spark)).collect()
    assert Counter((r["doc_id"], str(spans(r["base"]))) for r in got) == Counter(
        (r[0], str(base(r[1]))) for r in cases.rows()
    )
    assert pii.find_personal_data(cases.empty(spark)).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    """`reach me` introduces nine addresses; the tenth is spelled out of the patterns' reach."""
    rows = [(i, f"please reach me user{i}@mail.example.org today") for i in range(9)]
    rows += [(20, "please reach me (user20@mailhost), thanks"), (21, "chapter user21@mailhost no")]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    more = {r["doc_id"]: set(spans(r["spans"])) - set(spans(r["base"])) for r in got}
    start = rows[9][1].index("user20")
    assert more.pop(20) == {(start, 0, start + len("user20@mailhost"))}
    assert not any(more.values())


def found(spark, rows):
    """Texts of the discovered spans by document, without spans within others."""
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    return {r["doc_id"]: {
        (k, text[r["doc_id"]][a:b]) for a, k, b in set(spans(r["spans"])) - set(spans(r["base"]))
    } for r in got}


def test_identifiers_written_in_groups(spark):
    rows = [(i, f"please call me +1 499 555 65{i:02} today") for i in range(19)]
    plain = [f"4{'0' * 9}{i:05}" for i in range(9)]
    cards = [next(p + str(d) for d in range(10) if luhn(p + str(d))) for p in plain]
    rows += [(20 + i, f"with my card {c} today") for i, c in enumerate(cards)]
    rows += [
        (50, "so call me (212) 555-0147 now"), (51, "so call me 212 555 0147, 3 times"),
        (52, "so call me 212 - 555 - 0147. 5 of us"), (53, "so call me 212.555.0147"),
        (54, "then call me 212 555 0147 a@b.org"),  # a run ends at a base span
        (55, "see a@b.org or call me 212 555 0147 and call me 646 555 0147"),
        (60, "on my card 4111 1111 1111 1112 now"), (61, "chapter 4111 1111 1111 1112 now"),
        (62, "so call me 12 of"),  # too short
    ]
    got = {k: v for k, v in found(spark, rows).items() if v}
    assert got == {
        50: {(3, "(212) 555-0147")}, 51: {(3, "212 555 0147")}, 52: {(3, "212 - 555 - 0147")},
        53: {(3, "212.555.0147")}, 54: {(3, "212 555 0147")},
        55: {(3, "212 555 0147"), (3, "646 555 0147")}, 60: {(2, "4111 1111 1111 1112")},
    }
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[50] == "so call me [PHONE] now" and clean[60] == "on my card [CARD] now"


def test_address_ends_at_its_word(spark):
    rows = [(i, f"please reach me user{i}@mail.example.org today") for i in range(9)]
    rows += [(20, "please reach me user20@mailhost 12 times")]
    assert found(spark, rows)[20] == {(0, "user20@mailhost")}


def test_context_is_the_text_before(spark):
    """Also where other matches stand in it, and in code points."""
    text = "é🙂 x@y.z p@q.r then " + "w" * 70 + " 12 34 a1"
    df = spark.createDataFrame([(text,)], "t string")
    for pattern, needs in ((pii.EMAIL, "@"), (pii.MENTION, "[0-9@]")):
        got = df.select(pii.matches(df.t, pattern, needs)).first()[0]
        assert got and all(m["left"] == text[max(m["start"] - pii.CONTEXT, 0) : m["start"]] for m in got)


@pytest.mark.parametrize(
    "text, want",
    [
        ("mail a@b.c now", "mail [EMAIL] now"),
        ("é🙂 1.2.3.4", "é🙂 [IP]"),
        ("nothing", "nothing"),
        ("card 4111-1111 1111 1111!", "card [CARD]!"),
        (None, None),
    ],
)
def test_redaction(spark, text, want):
    df = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, n_chars long")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert out.first()["text"] == want


def test_native_plan(spark):
    plan = pii.find_personal_data(cases.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 300])
def test_running_sums(spark, n):
    row = spark.range(1).select(F.expr(f"slice(sequence(0, {n}), 1, {n})").alias("items")).select(
        pii.running(
            F.col("items"), F.lit(0), "array<int>", lambda c, i: (c + i, F.array(c + i)),
            lambda c: F.array(-c),
        ).alias("got")
    ).first()
    sums = [i * (i + 1) // 2 for i in range(n)]
    assert row["got"] == [*sums, -sums[-1] if sums else 0]


def test_a_text_of_many_numbers(spark):
    numbers = " ".join(f"a{i}@b.org" for i in range(20_000))
    got = pii.find_personal_data(spark.createDataFrame([(1, numbers)], "doc_id long, text string")).first()
    assert len(got["base"]) == 20_000 and got["base"][-1]["end"] == len(numbers)


def test_words_before_are_whole(spark):
    left = ["x" * 60 + " ab", "x" * 63 + " ab", "y" * 70, " " + "z" * 63, "z" * 63]
    rows = spark.createDataFrame([(t[-pii.CONTEXT:],) for t in left], "t string")
    got = [tuple(r) for r in rows.select(pii.before(F.col("t"), 1), pii.before(F.col("t"), 2)).collect()]
    z = "z" * 63
    assert got == [("ab", "x" * 60 + " ab"), ("ab", None), (None, None), (z, None), (z, None)]


def test_mentions_outside_spans(spark):
    draw = random.Random(4)
    for _ in range(4):
        cuts = sorted(draw.sample(range(200), 40))
        mentions = [(a, b, str(a), "") for a, b in zip(cuts[::2], cuts[1::2])]
        covered = [(a, a + draw.randint(1, 9), "", "") for a in draw.sample(range(200), 12)]
        df = spark.createDataFrame([(mentions, covered)], f"m {pii.SPANS}, c {pii.SPANS}")
        got = [tuple(m) for m in df.select(pii.outside(df.m, df.c)).first()[0]]
        assert got == [m for m in mentions if not any(c[0] < m[1] and m[0] < c[1] for c in covered)]
