"""Text expressions: whitespace, tokens, previews."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path
from zipfile import ZipFile

import pyspark
from pyspark.sql import Column, functions as F

# Every code point that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Token shapes. Letters, digits and underscore of any script.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
LONG_WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

LONGEST_KEY = 128

STOP_WORDS_FILE = "org/apache/spark/ml/feature/stopwords/english.txt"


def english_stop_words() -> tuple[str, ...]:
    """Spark's own English list, that of `StopWordsRemover.loadDefaultStopWords("english")`.

    It is read from Spark's jar, so that it can be had, and named in SQL, without a session.
    """
    homes = [Path(pyspark.__file__).parent, *map(Path, filter(None, [os.environ.get("SPARK_HOME")]))]
    for jar in (jar for home in homes for jar in sorted(home.glob("jars/spark-mllib_*.jar"))):
        with ZipFile(jar) as files:
            return tuple(files.read(STOP_WORDS_FILE).decode().split())
    raise FileNotFoundError(f"no spark-mllib jar in {', '.join(map(str, homes))}")


# Default stop words; every operator that uses them takes another list as a parameter.
STOP_WORDS = english_stop_words()


def strip_unicode(text: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode whitespace included."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased tokens in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def content_words(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Tokens of two or more word characters without the stop words."""
    tokens = words(text, LONG_WORD_PATTERN)
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(*stop_words))


def word_key(word: Column) -> Column:
    """The word itself, or a digest of fixed length that stands for a very long one.

    No word starts with the sign of a digest, so different words keep different keys.
    """
    return F.when(F.length(word) > LONGEST_KEY, F.concat(F.lit("#"), F.md5(word))).otherwise(word)


def preview(text: Column, width: int = 100) -> Column:
    """First `width` characters followed by an ellipsis."""
    return F.concat(F.substring(text, 1, width), F.lit("..."))


def fixed_point(value: Column, digits: int) -> Column:
    """Number as text with exactly `digits` decimals; null for null."""
    shown = F.format_string(f"%.{digits}f", F.round(value.cast("double"), digits))
    return F.when(value.isNotNull(), shown)
