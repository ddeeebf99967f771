"""Answers kept between runs."""

import uuid
from collections import Counter
from pathlib import Path

import pytest

from labelloom.operators import kept_labels, labelling

SCHEMA = "id long, t string, digest string"
ROWS = [(1, "vaccine good", "x"), (2, "vaccine bad", "x"), (3, None, "x"), (4, "", "x"), (None, "alone", None)]
ROWS += [(10 + i, "the same", "x") for i in range(200)]


def notebook(folder, fail=None, silent=()):
    """A model that notes each text it is asked, in files all workers can reach."""

    class Noting:
        def predict(self, texts):
            if fail in texts:
                raise RuntimeError("the model is down")
            for text in texts:
                (Path(folder) / uuid.uuid4().hex).write_text(text)
            return [None if t in silent else f"{t} is against" for t in texts]

    return Noting


def asked(folder):
    return Counter(p.read_text() for p in Path(folder).iterdir())


def run(df, model, path, version="1", **options):
    options = {"steps": 2, **options}
    got = kept_labels.batch_label_kept(df, model, "id", "t", str(path / "store"), version, **options)
    return Counter(map(tuple, got.collect()))


@pytest.fixture
def notes(tmp_path):
    (tmp_path / "notes").mkdir()
    return tmp_path / "notes"


@pytest.mark.parametrize("hot", [50, 100_000])
def test_each_text_is_asked_once(spark, tmp_path, notes, monkeypatch, hot):
    monkeypatch.setattr(kept_labels, "HOT_ROWS", hot)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    whole = labelling.batch_label(df, notebook(tmp_path), "id", "t")
    want = Counter(map(tuple, whole.collect()))
    assert run(df.limit(0), notebook(notes), tmp_path) == Counter()
    assert run(df, notebook(notes), tmp_path) == want
    texts = {t or "" for _, t, _ in ROWS}
    assert asked(notes) == Counter(texts)
    more = df.unionByName(spark.createDataFrame([(7, "new", "x")], SCHEMA))
    assert run(more, notebook(notes), tmp_path).total() == want.total() + 1
    assert asked(notes) == Counter(texts | {"new"})
    run(df, notebook(notes), tmp_path, "2")  # another model is asked anew
    assert asked(notes) == Counter(texts | {"new"}) + Counter(texts)


def test_a_failed_run_goes_on(spark, tmp_path, notes):
    rows = [(i, f"text {i}", "") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    with pytest.raises(Exception, match="model is down"):
        run(df, notebook(notes, fail="text 7"), tmp_path, steps=6)
    kept = kept_labels.kept_answers(spark, str(tmp_path / "store"), "1").count()
    assert 0 < kept < 60
    for note in notes.iterdir():
        note.unlink()
    assert run(df, notebook(notes), tmp_path, steps=6).total() == 60
    assert asked(notes).total() == 60 - kept


def test_missing_answers_are_asked_again(spark, tmp_path, notes):
    df = spark.createDataFrame([(1, "a", ""), (2, "b", "")], SCHEMA)
    first = run(df, notebook(notes, silent=("b",)), tmp_path, on_error="null")
    assert {(k, raw) for k, _, raw in first} == {(1, "a is against"), (2, None)}
    assert {k for k, label, _ in run(df, notebook(notes), tmp_path) if label == "against"} == {1, 2}
    assert asked(notes) == Counter({"a": 1, "b": 2})


def test_other_columns_stay(spark, tmp_path, notes):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = kept_labels.append_predictions_kept(df, notebook(notes), "t", str(tmp_path / "s"), "1", into="p")
    assert Counter(map(tuple, got.drop("p").collect())) == Counter(ROWS)
    with pytest.raises(ValueError, match="plain name"):
        kept_labels.kept_answers(spark, "s", "a/b")
