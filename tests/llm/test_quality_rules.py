"""Quality rules and line frequency against plain Python."""

import random
import re
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from labelloom.llm import quality_rules as rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(line):
    return re.sub("[0-9]", "0", " ".join(WORDS.findall(line))).lower()


def repeats(words, width=8):
    at = defaultdict(list)
    for i in range(len(words) - width + 1):
        at[tuple(words[i : i + width])].append(i)
    return len({p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + width)})


def expected(rows, limits=rules.Limits()):
    documents, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORDS.search(line):
                documents[host, plain(line)].add(text or "")
    most = {h: max(limits.line_docs, len(d) * limits.line_pct // 100) for h, d in hosts.items()}
    out, texts = Counter(), Counter()
    for key, text, host in rows:
        body = text or ""
        words, lines = WORDS.findall(body), [x for x in body.split("\n") if WORDS.search(x)]
        shared = [len(documents[host, plain(x)]) > most[host] for x in lines]
        gone = sum(len(WORDS.findall(x)) for x, s in zip(lines, shared) if s)
        again = repeats(words)
        failed = len(words) < 20 or 100 * again > 30 * len(words)
        kept = not failed and 100 * (len(words) - gone) >= limits.left_pct * len(words)
        symbols = sum(c in "#*$%&|<>" for c in body)
        out[(key, len(words), len("".join(words)), symbols, len(lines) - len(set(lines)), again, failed, kept, gone)] += 1
        if kept:
            rest = "\n".join(x for x, s in zip(lines, shared) if not s)
            texts[(key, rest if any(shared) else text, host)] += 1
    return out, texts


def boilerplate():
    """Hosts with banners, one of them most of the rows; copies of one text are no banner."""
    rows = [(i, f"{cases.words(i, 30)}\nShared  Banner {i} of us\n{cases.words(900 + i, 5)}", "hot") for i in range(40)]
    rows += [(100 + i, f"one\n{'banner ' * 3}\nshared banner 7 of US " * 4 + cases.words(i, 9), "hot") for i in range(3)]
    rows += [(200 + i, f"{cases.words(77, 25)}\nfoot {i}", None) for i in range(12)]  # near copies: one shared line
    rows += [(300 + i, cases.words(5, 60), "copies") for i in range(30)]
    rows += [(400, "a b c d e f g h " * 9, "other"), (401, "x " * 25, "other"), (None, None, None), (402, "", "")]
    return rows


SCHEMA = "doc_id long, text string, source string"


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_verdicts(spark, digest):
    """A weak hash of windows sends every text to the exact comparison."""
    rows = boilerplate() + [(i, t, s) for i, t, _, s, *_ in cases.rows()]
    got = rules.judge_documents(spark.createDataFrame(rows, SCHEMA).repartition(5), digest=digest)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows)[0]


def test_texts_without_shared_lines(spark):
    rows, limits = boilerplate(), rules.Limits(line_docs=5, line_pct=1, left_pct=50)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row", "lines", "kept")})
    got = rules.clean_documents(docs, limits=limits)
    want = expected(rows, limits)[1]
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == want
    assert any("banner" not in t for _, t, h in want if h == "hot")


def test_repeated_windows(spark):
    draw = random.Random(1)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 60))) for _ in range(60)]
    texts.append(" ".join(["w"] * 20_000))  # every window the same
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(rules.repeated_words(rules.words_of(F.col("t")))).collect()]
    assert got == [repeats(WORDS.findall(t)) for t in texts]


def test_no_rows_and_native_plan(spark):
    empty = spark.createDataFrame([], SCHEMA)
    judged = rules.judge_documents(empty)
    assert judged.count() == 0 and rules.clean_documents(empty).count() == 0
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
