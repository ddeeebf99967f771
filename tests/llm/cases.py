"""A small table with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, salt int"


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice("abcdefgh") + str(draw.randint(0, 999)) for _ in range(n))


def near(text: str, seed: int, edits: int) -> str:
    draw, parts = random.Random(seed), text.split(" ")
    for _ in range(edits):
        parts[draw.randrange(len(parts))] = f"new{draw.randint(0, 99999)}"
    return " ".join(parts)


def rows() -> list[tuple]:
    base, passage = words(1, 120), words(2, 40)
    texts = [
        (1, base), (2, base.replace(" ", "\t\n")), (3, base),  # copies but for white space
        *[(10 + i, near(base, i, 3)) for i in range(12)],  # near copies, some of each other
        (30, f"{words(3, 20)} {passage} {words(4, 15)}"),
        (31, f"{words(5, 9)} {passage}"),
        (32, f"{passage} {passage}"),  # a passage twice in one text
        (40, ""), (41, None), (42, " \n\t "), (43, "one two"), (44, "one two"),
        (45, "x" * 50_000), (46, words(6, 6000)),
        (50, "Ünïcode — 漢字 🙂 mail a.b@c.example.org, call +1 (499) 555-6503 or 192.168.0.1"),
        (51, "card 4111 1111 1111 1111 and 4111 1111 1111 1112 and 300.1.1.1"),
        (None, base), (None, words(7, 50)), (None, words(7, 50)),
        (60, words(8, 30)), (60, words(8, 30)),  # a repeated row
        (61, words(9, 30)), (61, words(10, 30)),  # a key with two texts
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", f"src{n % 3}", None if t is None else len(t), "k", n)
        for n, (i, t) in enumerate(texts)
    ]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
