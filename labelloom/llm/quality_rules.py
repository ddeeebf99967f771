"""Quality rules on whole texts, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import SPACE, stored, table, whole
from labelloom.llm.registry import query
from labelloom.plans.lookup import lookup_join

# What the rules count.
BLANKS = " \t\n\x0b\x0c\r"
BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PCT = 30

# A line is shared too widely beyond both limits: documents, and % of its host's documents.
LINE_DOCS = 10
LINE_PCT = 5
LEFT_PCT = 30  # a document with less than this share of its words left is depleted

Hash = Callable[[Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text: what white space separates."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.expr("CAST(array() AS array<string>)")).otherwise(
        F.split(trimmed, SPACE)
    )


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def covered(places: Column, width: int) -> Column:
    """How many places the windows that start at `places` (ascending, distinct) cover together."""
    reach = F.transform(
        places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width)))
    )
    return F.aggregate(reach, F.lit(0), lambda total, n: total + n)


def repeated_words(words: Column, width: int = WINDOW, digest: Hash = F.xxhash64) -> Column:
    """Words in windows of `width` words that are found twice or more in the text.

    Distinct hashes prove distinct windows, so most texts need no more than their hashes. In
    the others the windows themselves are sorted and compared with their neighbours: the
    work is that of a sort, however often a window is repeated.
    """

    def twice(ordered: Column) -> Column:
        same = lambda s, j: F.coalesce(F.get(ordered, j)["words"] == s["words"], F.lit(False))
        marked = F.transform(ordered, lambda s, i: F.when(same(s, i - 1) | same(s, i + 1), s["at"]))
        return let(F.sort_array(F.filter(marked, lambda at: at.isNotNull())), lambda p: covered(p, width))

    def counted(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
        window = lambda i: F.slice(words, i, width)
        distinct = let(
            F.transform(starts, lambda i: digest(window(i))), lambda h: F.size(F.array_distinct(h)) == F.size(h)
        )
        joined = F.transform(
            starts, lambda i: F.struct(F.array_join(window(i), " ").alias("words"), i.alias("at"))
        )
        none = (F.size(words) < width) | distinct
        return F.when(none, F.lit(0)).otherwise(let(F.sort_array(joined), twice))

    return let(words, counted)


def line_key(host: Column, line: Column) -> Column:
    """The hash of a line of a host: lower case, white space as one space, digits as 0."""
    plain = F.regexp_replace(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), SPACE, " "), "[0-9]", "0")
    return F.md5(F.concat(host, F.lit("\n"), F.lower(plain)))


@dataclass(frozen=True)
class Limits:
    """Beyond both of the first two a line goes; under the third a document goes."""

    line_docs: int = LINE_DOCS
    line_pct: int = LINE_PCT
    left_pct: int = LEFT_PCT


def measured(
    docs: DataFrame, key: str, text: str, host: str, carry: Sequence[str] = (), digest: Hash = F.xxhash64
) -> DataFrame:
    """One stored row per row of `docs`: a number of its own, the base counts and the lines' hashes.

    The number is part of what is written, so it stays with its row.
    """
    body = whole(text)
    name = F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))
    carried = [F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []
    split = docs.select(
        F.col(key).alias("key"), name.alias("host"), body.alias("body"), *carried,
        words_of(body).alias("words"), lines_of(body).alias("lines"),
    )
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length(F.regexp_replace("body", NOT_SYMBOL, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_words(F.col("words"), digest=digest),
    }
    hashed = F.transform(
        "lines",
        lambda line: F.struct(
            line_key(F.col("host"), line).alias("line"), F.size(words_of(line)).alias("words")
        ),
    )
    return stored(
        split.select(
            F.monotonically_increasing_id().alias("row"), "key", "host",
            F.xxhash64("host", "body").alias("content"),
            *[value.cast("long").alias(n) for n, value in counts.items()],
            hashed.alias("lines"), *(["carried"] if carry else []),
        ),
        "rule-measures",
    )


def shared_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """The occurrences of lines above the limits: `row, nth, words`.

    Documents are counted as different contents, by a 64-bit hash, so that copies of one
    text do not make its lines look like boilerplate: removing copies is not
    this operator's work. A host's documents are counted likewise. Both counts combine
    before their shuffles; a line or host with a third of all rows is one row per task then.
    """
    sizes = rows.groupBy("host").agg(F.count_distinct("content").alias("docs"))
    most = F.greatest(F.lit(limits.line_docs), F.floor(F.col("docs") * limits.line_pct / 100))
    found = lookup_join(
        rows.select("row", "host", "content", "lines"), sizes.select("host", most.cast("long").alias("most")), "host"
    ).select("row", "content", "most", F.posexplode("lines").alias("nth", "at"))
    found = found.select("row", "content", "most", "nth", "at.line", "at.words")
    counts = found.groupBy("line", "most").agg(F.count_distinct("content").alias("docs"))
    above = counts.filter(F.col("docs") > F.col("most")).select("line")
    return lookup_join(found.select("row", "nth", "line", "words"), above, "line").drop("line")


def verdicts(rows: DataFrame, removed: DataFrame, limits: Limits) -> DataFrame:
    """The measured rows with `n_removed` words, `base_failed` and `kept`."""
    judged = rows.drop("lines").join(removed, "row", "left")
    n = F.col("n_words")
    gone = F.coalesce("n_removed", F.lit(0)).cast("long")
    base = (n < LEAST_WORDS) | (n * REPEATED_PCT < F.col("n_repeat_words") * 100)
    depleted = (n - gone) * 100 < n * limits.left_pct
    return judged.withColumns(
        {"n_removed": gone, "base_failed": base, "kept": ~base & ~depleted}
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    limits: Limits = Limits(), digest: Hash = F.xxhash64,
) -> DataFrame:
    """One row per row of `docs`: key, the base counts, `base_failed`, `kept`, `n_removed`.

    Base: `word_chars` code points in words; `n_symbols` characters of #*$%&|<>;
    `n_dup_lines` lines with a word that equal an earlier one; `n_repeat_words` words in
    8-word windows found twice or more. A document fails with under 20 words, or over 30 % repeated
    words. Then, across documents: lines found in more documents of a host than both
    limits allow are removed, and a document with too few of its words left is rejected.

    A null or empty text has no words and fails. A null host is a host of its own. Repeated rows
    and null keys are judged like others; other columns are ignored; an empty table gives no rows.
    """
    rows = measured(docs, key, text, host, digest=digest)
    gone = shared_lines(rows, limits).groupBy("row").agg(F.sum("words").alias("n_removed"))
    judged = verdicts(rows, gone, limits)
    return judged.select(F.col("key").alias(key), *COUNTS, "base_failed", "kept", "n_removed")


def clean_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """The rows that `judge_documents` keeps, all columns, their texts without the shared lines.

    Lines without a word stay only where no line of the text is removed.
    """
    rows = measured(docs, key, text, host, carry=docs.columns)
    gone = shared_lines(rows, limits).groupBy("row").agg(
        F.sum("words").alias("n_removed"), F.collect_set("nth").alias("removed")
    )
    kept = verdicts(rows, gone, limits).filter("kept").select("carried.*", F.col("removed").alias("__removed"))
    lines = lines_of(whole(text))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__removed"))
    rest = let(lines, lambda all_lines: F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"))
    return kept.withColumn(text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(rest)).select(
        *docs.columns
    )


SQL = rf"""WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS body
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(body, '{WORD}+') AS words,
         list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM t
), starts AS (
  SELECT id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8
), windows AS (
  SELECT id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS body FROM starts
), twice AS (
  SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, body) > 1
), reach AS (
  SELECT id, least(8, coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, 8)) AS n FROM twice
), repeats AS (SELECT id, sum(n)::BIGINT AS n FROM reach GROUP BY id
), hosts AS (
  SELECT host, greatest({LINE_DOCS}, count(DISTINCT md5(body)) * {LINE_PCT} // 100) AS most FROM t GROUP BY host
), lines AS (
  SELECT id, host, md5(body) AS content, unnest(lines) AS line FROM w
), plain AS (
  SELECT id, host, content, len(regexp_extract_all(line, '{WORD}+')) AS n, lower(regexp_replace(
    trim(regexp_replace(line, '{SPACE}', ' ', 'g'), ' '), '[0-9]', '0', 'g')) AS line
  FROM lines
), above AS (
  SELECT host, line FROM plain JOIN hosts USING (host) GROUP BY host, line, most
  HAVING count(DISTINCT content) > most
), gone AS (
  SELECT id, sum(n)::BIGINT AS n FROM plain JOIN above USING (host, line) GROUP BY id
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(body, '{NOT_SYMBOL}', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(g.n, 0) AS n_removed
  FROM w LEFT JOIN repeats r USING (id) LEFT JOIN gone g USING (id)
)
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PCT} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PCT} * n_words
            OR 100 * (n_words - n_removed) < {LEFT_PCT} * n_words) AS kept
FROM counted"""


@query(SQL)
def op11_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and the verdict of the rules."""
    return judge_documents(table(spark, sf_dir, "documents"))
