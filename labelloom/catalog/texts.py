"""Queries: prompts, sequences, labelling, features and the classifier."""

from __future__ import annotations

from functools import lru_cache, partial

import public_tokenizers
from pyspark.sql import functions as F

from labelloom.catalog import inputs as i
from labelloom.catalog.preparation import rounded
from labelloom.catalog.registry import query
from labelloom.functions import labels as rules
from labelloom.functions.prompts import TEMPLATES, render_prompt as fill
from labelloom.functions.sequences import IGNORED, PAD_ID, restore_mask
from labelloom.functions.text import STOP_WORDS
from labelloom.operators import (
    classifier, features, kept_labels, labelling, pieces, resample, sequences, split,
)
from labelloom.plans.lookup import settle
from labelloom.plans.scratch import scratch_path


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def prompt_sql(template: str, text: str = "text") -> str:
    before, after = TEMPLATES[template].split("{tweet}")
    return f"{literal(before)} || {text} || {literal(after)}"


@query(
    "SELECT doc_id, "
    + ", ".join(f"{prompt_sql(name)} AS {name}" for name in TEMPLATES)
    + " FROM documents"
)
def render_prompt(spark, sf_dir):
    return i.documents(spark, sf_dir).select(
        "doc_id", *[fill(F.col("text"), name).alias(name) for name in TEMPLATES]
    )


@query(
    f"SELECT doc_id, {prompt_sql('instruction')} AS text, lang AS label_text FROM documents"
)
def training_pairs(spark, sf_dir):
    return sequences.training_pairs(i.documents(spark, sf_dir), "doc_id", "text", "lang")


WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
VOCABULARY = f"""tokens AS (SELECT unnest({WORDS.format("text")}) AS token FROM documents),
vocabulary AS (
  SELECT token, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, token) + 2)::INTEGER AS id
  FROM tokens GROUP BY token ORDER BY n DESC, token LIMIT 8000)"""


def _vocabulary(spark, sf_dir):
    return sequences.vocabulary(i.spread_documents(spark, sf_dir), "text")


@query(f"WITH {VOCABULARY} SELECT token, n, id FROM vocabulary")
def vocabulary(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


@query(f"WITH {VOCABULARY} SELECT token, n, id FROM vocabulary")
def vocabulary_summarised(spark, sf_dir):
    """The same from bounded summaries of each task's tokens."""
    return sequences.vocabulary(i.spread_documents(spark, sf_dir), "text", summary=30_000)


def encoded_sql(name: str, text: str, length: int) -> str:
    """CTEs with the ids of a text, the end id included: `(doc_id, ids)`."""
    return f"""{name}_t AS (
  SELECT doc_id, list_slice({WORDS.format(text)}, 1, {length - 1}) AS ts FROM documents
), {name}_p AS (
  SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM {name}_t
), {name}_i AS (
  SELECT doc_id, list(coalesce(id, 2) ORDER BY pos) AS ids
  FROM {name}_p LEFT JOIN vocabulary USING (token) GROUP BY doc_id
), {name} AS (
  SELECT doc_id, list_append(coalesce(ids, []::INTEGER[]), 1) AS ids
  FROM {name}_t LEFT JOIN {name}_i USING (doc_id))"""


def padded_sql(ids: str, length: str) -> str:
    return f"list_resize({ids}, {length}, 0)"


TEXT_IDS = encoded_sql("x", prompt_sql("instruction"), 256)
TARGET_IDS = encoded_sql("y", "lang", 16)


def _encoded(spark, sf_dir, vocab=None):
    vocab = _vocabulary(spark, sf_dir) if vocab is None else vocab
    pairs = sequences.training_pairs(i.spread_documents(spark, sf_dir), "doc_id", "text", "lang")
    return sequences.encode_sequence(pairs, vocab, "doc_id", "text", "label_text")


def spaced(*columns):
    return [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in columns]


@query(
    f"""WITH {VOCABULARY}, {TEXT_IDS}, {TARGET_IDS}
SELECT x.doc_id, array_to_string({padded_sql("x.ids", "256")}, ' ') AS input_ids,
       array_to_string({padded_sql("y.ids", "16")}, ' ') AS labels
FROM x JOIN y ON x.doc_id = y.doc_id"""
)
def encode_sequence(spark, sf_dir):
    return _encoded(spark, sf_dir).select("doc_id", *spaced("input_ids", "labels"))


@query(
    f"""WITH {VOCABULARY}, {encoded_sql("x", prompt_sql("assistant"), 512)}, {encoded_sql("y", "lang", 10)}
SELECT x.doc_id, array_to_string({padded_sql("x.ids", "512")}, ' ') AS input_ids,
       array_to_string({padded_sql("y.ids", "10")}, ' ') AS labels
FROM x JOIN y ON x.doc_id = y.doc_id"""
)
def encode_sequence_512(spark, sf_dir):
    vocab = settle(_vocabulary(spark, sf_dir))
    pairs = sequences.training_pairs(
        i.spread_documents(spark, sf_dir), "doc_id", "text", "lang", "assistant"
    )
    encoded = sequences.encode_sequence(pairs, vocab, "doc_id", "text", "label_text", 512, 10)
    return encoded.select("doc_id", *spaced("input_ids", "labels"))


@query(
    f"""WITH {VOCABULARY}, {encoded_sql("x", "text", 512)}
SELECT doc_id, array_to_string(ids, ' ') AS input_ids FROM x"""
)
def truncate_sequence(spark, sf_dir):
    vocab = settle(_vocabulary(spark, sf_dir))
    cut = sequences.truncate_sequence(i.spread_documents(spark, sf_dir), vocab, "doc_id", "text", 512)
    return cut.select("doc_id", *spaced("input_ids"))


@query(
    f"""WITH {VOCABULARY}, {encoded_sql("x", "text", 256)}, b AS (
  SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM x
), m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM b)
SELECT doc_id, batch_id, array_to_string({padded_sql("ids", "longest")}, ' ') AS input_ids FROM m"""
)
def batch_pad(spark, sf_dir):
    vocab = settle(_vocabulary(spark, sf_dir))
    cut = sequences.truncate_sequence(i.spread_documents(spark, sf_dir), vocab, "doc_id", "text", 256)
    padded = sequences.batch_pad(split.batch_ids(cut, "doc_id", 16), "input_ids")
    return padded.select("doc_id", "batch_id", *spaced("input_ids"))


@query(
    f"""WITH {VOCABULARY}, {TARGET_IDS}, m AS (
  SELECT doc_id, list_transform({padded_sql("ids", "16")},
                                lambda v: CASE WHEN v = 0 THEN -100 ELSE v END) AS masked FROM y)
SELECT doc_id, array_to_string(masked, ' ') AS masked,
  array_to_string(list_transform(masked, lambda v: CASE WHEN v = -100 THEN 0 ELSE v END), ' ') AS labels
FROM m"""
)
def mask_restore(spark, sf_dir):
    hide = F.transform("labels", lambda v: F.when(v == PAD_ID, IGNORED).otherwise(v))
    masked = _encoded(spark, sf_dir).select("doc_id", hide.alias("masked"))
    return masked.withColumn("labels", restore_mask(F.col("masked"))).select(
        "doc_id", *spaced("masked", "labels")
    )


@query(
    f"""WITH {VOCABULARY}, {TEXT_IDS}
SELECT doc_id, coalesce(words, '') AS text FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS words
  FROM x_p JOIN vocabulary USING (token) GROUP BY doc_id) USING (doc_id)"""
)
def decode_sequence(spark, sf_dir):
    vocab = settle(_vocabulary(spark, sf_dir))
    return sequences.decode_sequence(_encoded(spark, sf_dir, vocab), vocab, "doc_id", "input_ids")


@lru_cache(maxsize=1)
def _pieces():
    return pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


@query()
def subword_vocabulary(spark, sf_dir):
    """The pieces of a given vocabulary that the corpus uses, with their counts."""
    return pieces.piece_counts(i.spread_documents(spark, sf_dir), "text", _pieces())


@query()
def subword_encode(spark, sf_dir):
    """Prompts and targets as fixed-length arrays of piece ids."""
    pairs = sequences.training_pairs(i.spread_documents(spark, sf_dir), "doc_id", "text", "lang")
    wanted = {"input_ids": ("text", 256), "labels": ("label_text", 16)}
    encoded = pieces.encode_pieces(pairs, "doc_id", wanted, _pieces())
    return encoded.select("doc_id", *spaced("input_ids", "labels"))


@query()
def subword_batch_pad(spark, sf_dir):
    """Piece ids cut to 512 and filled up to the longest of each batch."""
    rows = i.spread_documents(spark, sf_dir)
    cut = pieces.encode_pieces(rows, "doc_id", {"input_ids": ("text", 512)}, _pieces(), padded=False)
    padded = sequences.batch_pad(split.batch_ids(cut, "doc_id", 16), "input_ids")
    return padded.select("doc_id", "batch_id", *spaced("input_ids"))


@query("SELECT doc_id, text FROM documents")
def subword_decode(spark, sf_dir):
    """Whole texts to piece ids and back: nothing is lost, no word is unknown."""
    rows = i.spread_documents(spark, sf_dir)
    encoded = pieces.encode_pieces(rows, "doc_id", {"ids": ("text", None)}, _pieces())
    return pieces.decode_pieces(encoded, "doc_id", "ids", _pieces())


@query(
    f"""WITH {i.ANSWERED}
SELECT o_orderkey, answer, {i.LENIENT.format("answer")} AS label FROM answered"""
)
def label_lenient(spark, sf_dir):
    return i.answers(spark, sf_dir).withColumn("label", rules.label_lenient(F.col("answer")))


@query(
    f"""WITH {i.ANSWERED}
SELECT o_orderkey, {i.SUBSTRING.format("answer")} AS pred_label,
       {i.SUBSTRING.format("'truth: ' || upper(answer)")} AS true_label FROM answered"""
)
def label_substring(spark, sf_dir):
    truth = F.concat(F.lit("truth: "), F.upper("answer"))
    return i.answers(spark, sf_dir).select(
        "o_orderkey",
        rules.label_substring(F.col("answer")).alias("pred_label"),
        rules.label_substring(truth).alias("true_label"),
    )


@query(
    f"""WITH {i.ANSWERED}
SELECT o_orderkey, answer,
       CASE WHEN trim(answer) IN ('in-favor', 'against', 'neutral-or-unclear') THEN trim(answer)
            ELSE 'neutral-or-unclear' END AS label FROM answered"""
)
def label_strict(spark, sf_dir):
    return i.answers(spark, sf_dir).withColumn("label", rules.label_strict(F.col("answer")))


@query(
    f"""SELECT conv_id, turn, role, {i.LENIENT.format("text")} AS lenient,
       {i.SUBSTRING.format("text")} AS substring,
       CASE WHEN trim(text) IN ('in-favor', 'against', 'neutral-or-unclear') THEN trim(text)
            ELSE 'neutral-or-unclear' END AS strict FROM conversations"""
)
def label_rules_conversations(spark, sf_dir):
    """The three answer rules over given texts."""
    text = F.col("text")
    return i.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", rules.label_lenient(text).alias("lenient"),
        rules.label_substring(text).alias("substring"), rules.label_strict(text).alias("strict"),
    )


# Word lists that occur in the driver texts.
GATE = ("the ", "und", "que")
AGAINST = ("con ", "mit ", "that")
FAVOR = ("get", "der", "des")
WORD_LISTS = {"gate": GATE, "against": AGAINST, "favor": FAVOR}


def any_sql(words: tuple[str, ...], text: str = "text") -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{w}')" for w in words) + ")"


KEYWORD = f"""CASE WHEN {any_sql(GATE)} AND {any_sql(AGAINST)} THEN 'against'
            WHEN {any_sql(GATE)} AND {any_sql(FAVOR)} THEN 'in-favor'
            ELSE 'neutral-or-unclear' END"""


@query(f"SELECT doc_id, {KEYWORD} AS label FROM documents")
def keyword_label(spark, sf_dir):
    label = rules.keyword_label(F.col("text"), **WORD_LISTS)
    return i.documents(spark, sf_dir).select("doc_id", label.alias("label"))


load_keyword_model = partial(labelling.KeywordModel, **WORD_LISTS)


@query(f"SELECT doc_id, {KEYWORD} AS label_pred, {KEYWORD} AS raw_response FROM documents")
def batch_label(spark, sf_dir):
    return labelling.batch_label(i.spread_documents(spark, sf_dir), load_keyword_model, "doc_id", "text")


@query(f"SELECT doc_id, {KEYWORD} AS label_pred, {KEYWORD} AS raw_response FROM documents")
def batch_label_kept(spark, sf_dir):
    """Two runs on one store: the second finds every answer in it."""
    store = scratch_path(spark, "answers")
    rows = i.spread_documents(spark, sf_dir)
    for _ in range(2):
        labelled = kept_labels.batch_label_kept(rows, load_keyword_model, "doc_id", "text", store, "rule-1")
    return labelled


@query(f"SELECT conv_id, turn, role, text, {KEYWORD} AS label_pred FROM conversations")
def append_predictions_kept(spark, sf_dir):
    """Conversations whose answers are kept; most texts are repeated."""
    return kept_labels.append_predictions_kept(
        i.table(spark, sf_dir, "conversations"), load_keyword_model, "text",
        scratch_path(spark, "answers"), "rule-1", normalise=rules.label_strict,
    )


@query(f"SELECT conv_id, turn, role, text, {KEYWORD} AS label_pred FROM conversations")
def append_predictions(spark, sf_dir):
    return labelling.append_predictions(
        i.table(spark, sf_dir, "conversations"), load_keyword_model, "text",
        normalise=rules.label_strict,
    )


STOP = ", ".join(literal(word) for word in STOP_WORDS)
CONTENT = (
    r"list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}'), "
    f"lambda t: t NOT IN ({STOP}))"
)


@query(
    f"SELECT doc_id, array_to_string({CONTENT.format('text')}, ' ') AS tokens FROM documents"
)
def tokenize_words(spark, sf_dir):
    rows = features.tokenize_words(i.spread_documents(spark, sf_dir), "doc_id", "text")
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


SPLIT_DOCUMENTS = i.split_sql(
    "documents", "doc_id", "lang", 0.2, "42", "parted", ("train", "test")
)
TERMS = f"""occurrences AS (
  SELECT doc_id, split, unnest({CONTENT.format("text")}) AS term FROM parted
), counted AS (SELECT doc_id, split, term, count(*) AS tf FROM occurrences GROUP BY ALL
), terms AS (
  SELECT term, sum(tf)::BIGINT AS n, count(*) AS df,
         ln((1.0::DOUBLE + (SELECT count(*) FROM parted WHERE split = 'train'))
            / (1.0::DOUBLE + count(*))) + 1 AS idf
  FROM counted WHERE split = 'train' GROUP BY term ORDER BY n DESC, term LIMIT 5000)"""


def _parted(spark, sf_dir):
    rows = i.spread_documents(spark, sf_dir).select("doc_id", "text", "lang")
    return split.stratified_split(rows, "doc_id", "lang")


@query(
    f"""WITH {SPLIT_DOCUMENTS}, {TERMS}
SELECT term, (row_number() OVER (ORDER BY n DESC, term) - 1)::INTEGER AS term_index, n, df,
       round(idf, 6) AS idf FROM terms"""
)
def tfidf_terms(spark, sf_dir):
    train = _parted(spark, sf_dir).filter("split = 'train'")
    return rounded(features.term_statistics(train, "text"), "idf")


@query(
    f"""WITH {SPLIT_DOCUMENTS}, {TERMS}
SELECT term, (row_number() OVER (ORDER BY n DESC, term) - 1)::INTEGER AS term_index, n, df,
       round(idf, 6) AS idf FROM terms"""
)
def tfidf_terms_summarised(spark, sf_dir):
    """The same from bounded summaries of each task's terms."""
    train = _parted(spark, sf_dir).filter("split = 'train'")
    return rounded(features.term_statistics(train, "text", summary=30_000), "idf")


@query(
    f"""WITH {SPLIT_DOCUMENTS}, {TERMS}, weighed AS (
  SELECT doc_id, split, term, tf, tf * idf AS raw FROM counted JOIN terms USING (term))
SELECT doc_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight
FROM weighed"""
)
def tfidf(spark, sf_dir):
    parted = _parted(spark, sf_dir)
    terms = features.term_statistics(parted.filter("split = 'train'"), "text")
    return rounded(features.tfidf(parted, terms, "doc_id", "text"), "weight")


def _fitted(spark, sf_dir):
    parted = _parted(spark, sf_dir)
    train = parted.filter("split = 'train'")
    weights = resample.class_weights(train, "lang", ("en", "fr", "de", "es"))
    weighted = resample.weighted_rows(train, "lang", weights)
    model = classifier.fit_classifier(weighted, "text", "lang", "weight")
    return parted, weighted, model


@query()
def fit_classifier(spark, sf_dir):
    _, _, fitted = _fitted(spark, sf_dir)
    return rounded(classifier.coefficients(fitted, spark), "coefficient")


@query("SELECT DISTINCT lang AS label, true AS gradient_ok FROM documents")
def classifier_optimum(spark, sf_dir):
    """At the optimum of the penalised loss, the gradient vanishes for every label."""
    _, weighted, fitted = _fitted(spark, sf_dir)
    found = classifier.gradients(fitted, weighted, "text", "lang", "weight")
    return found.select("label", "gradient_ok")


@query()
def predict_classifier(spark, sf_dir):
    parted, _, fitted = _fitted(spark, sf_dir)
    test = parted.filter("split = 'test'")
    return classifier.predict_classifier(fitted, test, "text").select(
        "doc_id", "lang", "label_pred"
    )


@query(f"WITH {SPLIT_DOCUMENTS} SELECT doc_id, true AS agreed FROM parted WHERE split = 'test'")
def predict_classifier_agrees(spark, sf_dir):
    """Every predicted label has the largest sum of term weights times coefficients."""
    parted, weighted, fitted = _fitted(spark, sf_dir)
    statistics = features.term_statistics(weighted, "text")
    return classifier.agreement(fitted, parted.filter("split = 'test'"), "doc_id", "text", statistics)
