"""URL verdicts: rules by host and path, else a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelloom.llm.common import table
from labelloom.llm.registry import query

# Terms of the default vocabulary. One strict term rejects a url; soft ones count together.
STRICT = "casino porn pornhub viagra xxx hentai escort escorts cialis cheap-pills spam-farm"
SOFT = (
    "adult ads bet bets bonus cheap click deal deals farm free gambling jackpot loan loans "
    "lottery pills poker sex slots spam track tracker win winner"
)
SOFT_HITS = 2


class Rule(NamedTuple):
    """`target` is a host followed by the start of a path; `verdict` is allow or block."""

    target: str
    verdict: str


RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# What ends no term; a letter of another script does, as any other sign.
ALPHANUMERIC = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


class UrlJudge:
    """Rules and vocabulary, built once per task; both are parameters of bounded size."""

    def __init__(
        self, rules: Sequence[Rule], strict: Sequence[str], soft: Sequence[str], soft_hits: int
    ) -> None:
        self.soft_hits = soft_hits
        self.paths: dict[str, list[tuple[str, Rule]]] = {}
        for rule in rules:
            host, slash, path = rule.target.partition("/")
            self.paths.setdefault(host.translate(LOWER), []).append((slash + path, rule))
        self.terms = ahocorasick.Automaton()
        for weight, terms in ((1, soft), (2, strict)):  # a term in both counts as strict
            for term in terms:
                self.terms.add_word(term.translate(LOWER), (term.translate(LOWER), weight))
        if len(self.terms):
            self.terms.make_automaton()

    @staticmethod
    def parts(url: str | None) -> tuple[str, str]:
        """Host and path; both empty where the url is null or has no `://`."""
        _, mark, rest = (url or "").partition("://")
        if not mark:
            return "", ""
        ends = [i for i in map(rest.find, "/?#") if i >= 0]
        host = rest[: min(ends, default=len(rest))]
        path = rest[len(host) :]
        ends = [i for i in map(path.find, "?#") if i >= 0]
        return host.translate(LOWER), path[: min(ends, default=len(path))]

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits the host or a domain above it, and the path's start."""
        best: Rule | None = None
        while host:
            for start, rule in self.paths.get(host, ()):
                if path.startswith(start) and (best is None or len(rule.target) > len(best.target)):
                    best = rule
            host = host.partition(".")[2]
        return best

    def hits(self, url: str) -> tuple[int, int]:
        """Distinct strict and soft terms in the url with no ASCII letter or digit on either side."""
        url = url.translate(LOWER)
        found: dict[str, int] = {}
        if len(self.terms):
            for end, (term, weight) in self.terms.iter(url):
                start = end - len(term) + 1
                before, after = url[start - 1 : start] if start else "", url[end + 1 : end + 2]
                if before not in ALPHANUMERIC and after not in ALPHANUMERIC:
                    found[term] = weight
        return sum(w == 2 for w in found.values()), sum(w == 1 for w in found.values())

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = self.parts(url)
        rule = self.rule(host, path)
        strict, soft = self.hits(url or "")
        bad = strict >= 1 or soft >= self.soft_hits
        verdict = rule.verdict if rule else "block" if bad else "allow"
        return host, path, rule.target if rule else None, verdict, strict, soft


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    *,
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = tuple(STRICT.split()),
    soft: Sequence[str] = tuple(SOFT.split()),
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """The rows with `host, path, rule, verdict, strict_hits, soft_hits` added.

    A rule decides where one fits; of several, the longest. Otherwise a url is blocked for
    one strict term or `soft_hits` distinct soft ones, counted over the whole url in lower
    case (A-Z), where a term counts only between characters that are no ASCII letters or digits. A null or
    empty url has empty parts and is allowed. Columns of the same names are replaced; rows
    are independent, nothing is shuffled, and repeated rows get the same verdict.
    """
    kind = "host string, path string, rule string, verdict string, strict_hits long, soft_hits long"

    @F.pandas_udf(kind)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = UrlJudge(rules, strict, soft, soft_hits)
        names = [part.split()[0] for part in kind.split(", ")]
        for batch in batches:
            yield pd.DataFrame([judge.judge(u) for u in batch], columns=names)

    new = [part.split()[0] for part in kind.split(", ")]
    kept = [c for c in pages.columns if c not in new]
    # The expression is evaluated once, and its fields are taken from the result.
    return pages.withColumn("__judged", judged(F.col(url))).select(*kept, "__judged.*")


def _oracle() -> str:
    """The same verdicts in SQL: terms between boundaries, the longest of the rules that fit."""
    rules = ", ".join(
        f"('{r.target}', '{r.target.partition('/')[0]}', '/{r.target.partition('/')[2]}', '{r.verdict}')"
        for r in RULES
    )
    terms = ", ".join(f"('{t}', {w})" for ts, w in ((STRICT, 2), (SOFT, 1)) for t in ts.split())
    return rf"""
    WITH u AS (
        SELECT page_id, url,
               translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
               translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), rules(rule, host_end, path_start, verdict) AS (VALUES {rules}),
    terms(term, weight) AS (VALUES {terms}),
    ruled AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
        FROM u JOIN rules ON (host = host_end OR ends_with(host, '.' || host_end))
                         AND starts_with(path, path_start)
        GROUP BY page_id
    ), hit AS (
        SELECT page_id, count(*) FILTER (weight = 2) AS strict_hits,
               count(*) FILTER (weight = 1) AS soft_hits
        FROM u JOIN terms ON regexp_matches(low, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])')
        GROUP BY page_id
    )
    SELECT page_id, host, path, rule,
           coalesce(ruled.verdict, CASE WHEN strict_hits >= 1 OR soft_hits >= {SOFT_HITS}
                                        THEN 'block' ELSE 'allow' END) AS verdict,
           coalesce(strict_hits, 0) AS strict_hits, coalesce(soft_hits, 0) AS soft_hits
    FROM u LEFT JOIN ruled USING (page_id) LEFT JOIN hit USING (page_id)
    """


@query(sql=_oracle())
def op2_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).drop("url")
