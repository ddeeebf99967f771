"""The three text stages of the pipeline, one after the other, against plain Python."""

import cases
from test_jaccard import expected as near_groups
from test_pii import KINDS, good

import corpus_pipeline as pipeline


def clean(text):
    """Base spans replaced by their kinds; the texts hold no overlapping ones."""
    found = sorted(
        (m.start(), m.end(), kind)
        for kind, pattern in KINDS for m in pattern.finditer(text) if good(kind, m.group())
    )
    for start, end, kind in reversed(found):
        text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
    return text


def fixture():
    base, other = cases.words(1, 120), cases.words(2, 90)
    texts = [base, other, base, cases.near(base, 3, 2), cases.near(other, 4, 30), base, cases.words(5, 40)]
    texts += [f"{cases.words(6, 30)} mail a@b.org or +1 (499) 555-6503", f"{cases.words(7, 30)} at 192.168.0.1 ok"]
    texts += [f"{cases.words(7, 30)} at 192.168.0.1 ok", cases.near(other, 8, 2)]
    return [(90 - 7 * i, t, "en", f"s{i}", len(t)) for i, t in enumerate(texts)]


def test_which_documents_stay(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(pipeline.STAGES)
    smallest = {}
    for r in rows:
        smallest[r[1]] = min(smallest.get(r[1], r), r)
    want = sorted(smallest.values())
    docs = stages["exact dedup"](spark, docs, "")
    assert sorted(tuple(r) for r in docs.collect()) == want
    roots = {root for _, root, _ in near_groups(want)[0]}
    want = [r for r in want if r[0] in roots]
    docs = stages["n-gram Jaccard join"](spark, docs, "")
    assert sorted(tuple(r) for r in docs.collect()) == want and len(want) < len(smallest)
    want = [(i, clean(t), *rest, len(clean(t))) for i, t, *rest, _ in want]
    docs = stages["personal data"](spark, docs, "")
    assert sorted(tuple(r) for r in docs.collect()) == want
    assert sum("[" in r[1] for r in want) == 2
