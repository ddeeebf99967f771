"""Personal data: fixed patterns, and identifiers that the patterns' contexts give away."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelloom.llm.common import SPACE, stored, table, whole
from labelloom.llm.registry import query

# The kinds and their patterns. Each is the plain pattern made linear: a match
# starts where a run of its characters starts or the match before ended, and runs give nothing back.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Words with a digit or an at sign: what could be an identifier of another form.
MENTION = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]++"
# How such words stand together as one identifier: what is between them, how the one before
# ends and the next begins. A comma or the end of a sentence parts them.
BETWEEN = r"^\x20(?:[-.()\[\]]\x20)?$"
ENDS, BEGINS = r"[\p{L}\p{N})\]-]$", r"^[\p{L}\p{N}+@(.\[-]"

CONTEXT = 64  # characters before an identifier that are searched for the whole words before it
BLOCK = 128  # steps of a running fold whose results are put together at once
MIN_SEEDS = 3  # different known identifiers that a pattern must have introduced
CONFIDENCE = 0.7
DOUBT = 1.0  # added to a pattern's instances, so that few of them prove little
ROUNDS = 2
SHORTEST = 4  # characters of an identifier, over all its words

SPANS = "array<struct<start:int,end:int,text:string,left:string>>"
CANDIDATES = "array<struct<start:int,end:int,text:string,left:string,word:boolean,run:boolean>>"


def running(
    items: Column, zero: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]],
    last: Callable[[Column], Column] | None = None,
) -> Column:
    """What a fold over an array gives out on its way, in one array of type `kind`.

    `step` takes what is carried and an item, and returns what is carried on and an array of
    results; `last` may add more at the end. Results are put together by blocks, so the cost is
    linear for arrays up to some hundred thousand items.
    """
    none, blocks = F.array().cast(kind), F.array().cast(f"array<{kind}>")

    def one(s: Column, item: Column) -> Column:
        carried, results = step(s["carried"], item)
        return F.struct(carried.alias("carried"), F.concat(s["out"], results).alias("out"))

    def block(s: Column, part: Column) -> Column:
        # Only the block's own results go through its steps.
        def joined(t: Column) -> Column:
            done = F.concat(s["done"], F.array(t["out"]))
            return F.struct(t["carried"].alias("carried"), done.alias("done"))

        return F.aggregate(part, F.struct(s["carried"].alias("carried"), none.alias("out")), one, joined)

    def finish(s: Column) -> Column:
        flat = F.flatten(s["done"])
        return F.concat(flat, last(s["carried"])) if last else flat

    def over(all_items: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(all_items) - 1, F.lit(0)), F.lit(BLOCK))
        start = F.struct(zero.alias("carried"), blocks.alias("done"))
        return F.aggregate(at, start, lambda s, i: block(s, F.slice(all_items, i + 1, F.lit(BLOCK))), finish)

    return F.get(F.transform(F.array(items), over), F.lit(0))


def luhn(digits: Column) -> Column:
    """True where the check digit is right."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def good_card(match: Column) -> Column:
    digits = digits_of(match)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def good_ip(match: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


class Kind(NamedTuple):
    name: str
    pattern: str
    needs: str  # a pattern without which there is no match, and that is quick to look for
    good: object
    spaced: bool  # identifiers may be written in groups, as several words


KINDS = (
    Kind("email", EMAIL, "@", lambda m: F.lit(True), False),
    Kind("ip", IP, "[0-9][.][0-9]", good_ip, False),
    Kind("card", CARD, "[0-9]", good_card, True),
    Kind("phone", PHONE, r"\+[0-9]", lambda m: F.length(digits_of(m)).between(9, 15), True),
)


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches as `start, end, text, left`, in code points; `left` is the text before the start.

    Spark gives the matches, and the pieces between them; their lengths add up to offsets, and
    their ends to the CONTEXT characters before a match, whatever other matches these hold.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(
        F.split(text, pattern, -1),
        lambda p: F.struct(F.length(p).alias("n"), F.right(p, F.lit(CONTEXT)).alias("left")),
    )
    # The last piece comes after the last match.
    pairs = F.slice(F.arrays_zip(found, pieces), F.lit(1), F.size(found))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))

    def step(state: Column, pair: Column) -> tuple[Column, Column]:
        first = state["at"] + pair["1"]["n"]
        end = first + F.length(pair["0"])
        left = F.right(F.concat(state["tail"], pair["1"]["left"]), F.lit(CONTEXT))
        span = F.struct(
            first.alias("start"), end.alias("end"), pair["0"].alias("text"), left.alias("left")
        )
        tail = F.right(F.concat(left, pair["0"]), F.lit(CONTEXT))
        return F.struct(end.alias("at"), tail.alias("tail")), F.array(span)

    spans = running(pairs, zero, SPANS, step)
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast(SPANS))


def checked(text: Column, kind: Kind) -> Column:
    """The matches of a kind that pass its check; one that fails is dropped, not tried again."""
    return F.filter(matches(text, kind.pattern, kind.needs), lambda s: kind.good(s["text"]))


def before(left: Column, count: int) -> Column:
    """The last `count` words of the text before an identifier; null where there are fewer."""
    cut = F.when(F.length(left) == CONTEXT, 2).otherwise(1)  # a word that may begin further left is left out
    words = F.split(F.lower(left), SPACE)
    words = F.filter(F.slice(words, cut, F.size(words)), lambda w: w != "")
    return F.when(F.size(words) >= count, F.array_join(F.slice(words, -count, count), " "))


def candidates(free: Column) -> Column:
    """Mentions, and the runs of mentions that stand together, with the forms they count as.

    `word` marks single words, `run` what may have several: runs of two or more, and words that
    begin none.
    """
    none = F.array().cast(CANDIDATES)

    def one(span: Column, word: bool, run: bool) -> Column:
        fields = [span[name].alias(name) for name in ("start", "end", "text", "left")]
        return F.array(F.struct(*fields, F.lit(word).alias("word"), F.lit(run).alias("run")))

    def opened(start: Column, end: Column, text: Column, left: Column, words: Column) -> Column:
        return F.struct(
            start.alias("start"), end.alias("end"), text.alias("text"), left.alias("left"),
            words.alias("words"),
        )

    def closed(run: Column) -> Column:
        last = F.when(run["words"] == 0, none).when(run["words"] == 1, one(run, True, True))
        return last.otherwise(one(run, False, True))

    def step(run: Column, m: Column) -> tuple[Column, Column]:
        gap = m["start"] - run["end"]
        between = F.right(m["left"], gap)
        linked = (
            (run["words"] > 0) & (gap <= 3) & between.rlike(BETWEEN)
            & run["text"].rlike(ENDS) & m["text"].rlike(BEGINS)
        )
        first = F.when(run["words"] == 1, one(run, True, False)).otherwise(none)
        longer = opened(
            run["start"], m["end"], F.concat(run["text"], between, m["text"]), run["left"], run["words"] + 1
        )
        fresh = opened(m["start"], m["end"], m["text"], m["left"], F.lit(1))
        results = F.when(linked, F.concat(first, one(m, True, True))).otherwise(closed(run))
        return F.when(linked, longer).otherwise(fresh), results

    nothing = opened(F.lit(0), F.lit(0), F.lit(""), F.lit(""), F.lit(0))
    return running(free, nothing, CANDIDATES, step, closed)


def outside(mentions: Column, covered: Column) -> Column:
    """The mentions that overlap none of the covered spans; one pass over both in order of their starts."""
    none = F.array().cast(SPANS)

    def tagged(spans: Column, tag: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(tag).alias("tag"), s.alias("span")))

    def step(state: Column, event: Column) -> tuple[Column, Column]:
        """`reach` is how far covered spans go; `waiting` a mention that the next span may still touch."""
        cover, span = event["tag"] == 0, event["span"]
        untouched = F.filter(state["waiting"], lambda m: m["end"] <= event["start"])
        new = F.when(state["reach"] <= event["start"], F.array(span)).otherwise(none)
        carried = F.struct(
            F.when(cover, F.greatest(state["reach"], span["end"])).otherwise(state["reach"]).alias("reach"),
            F.when(cover, untouched).otherwise(new).alias("waiting"),
        )
        return carried, F.when(cover, none).otherwise(state["waiting"])

    events = F.array_sort(F.concat(tagged(covered, 0), tagged(mentions, 1)))
    zero = F.struct(F.lit(0).alias("reach"), none.alias("waiting"))
    return running(events, zero, SPANS, step, lambda state: state["waiting"])


def scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row: `key, digest`, an array of base spans per kind, and the other mentions."""
    body = F.col("body")
    rows = docs.select(F.col(key).alias("key"), whole(text).alias("body"))
    found = rows.select(
        "key", F.sha2("body", 256).alias("digest"),
        *[
            checked(body, kind).alias(kind.name) for kind in KINDS
        ],
        matches(body, MENTION, "[0-9@]").alias("mention"),
    )
    return stored(found, "spans")


def discovered(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`digest, found` of the texts with identifiers that contexts give away.

    The base spans are seeds. The words before a seed, one or two, are its patterns; what else
    they introduce are their instances. Patterns and instances are scored in turns: a pattern, per
    kind, by the share of that kind in its different instances, an instance by its best
    pattern. Patterns need MIN_SEEDS different seeds and CONFIDENCE; what such a pattern
    introduces is an identifier of its kind: a run of mentions for kinds that are written in
    groups, a word for others. Each turn is two aggregates and two joins on
    pattern or instance, over one row per pattern and instance, however often they occur.
    """
    base = reduce(
        DataFrame.unionByName,
        [
            rows.select("digest", F.lit(i).alias("kind"), F.explode(k.name).alias("s"))
            for i, k in enumerate(KINDS)
        ],
    )
    seeds = base.select("kind", F.lower("s.text").alias("instance"), "s.left")
    free = outside(F.col("mention"), F.concat(*[F.col(k.name) for k in KINDS]))
    # The punctuation around an identifier is not part of it, but for a bracket that closes within.
    lead = r"^(?:(?!\([^(]*\)[^)]*[\p{L}\p{N}])[^\p{L}\p{N}+@])*+"
    core = F.regexp_replace("s.text", lead + r"|[^\p{L}\p{N}]+$", "")
    shift = F.length(F.regexp_extract("s.text", lead, 0))
    mentions = rows.select("digest", F.explode(candidates(free)).alias("s")).select(
        "digest", (F.col("s.start") + shift).alias("start"), core.alias("instance"), "s.left",
        "s.word", "s.run",
    )
    mentions = mentions.filter(F.length("instance") >= SHORTEST).select(
        "digest", "start", (F.col("start") + F.length("instance")).alias("end"),
        F.lower("instance").alias("instance"), "left", "word", "run",
    )
    spaced = F.col("kind").isin([i for i, k in enumerate(KINDS) if k.spaced])
    fits = F.when(spaced, F.col("run")).otherwise(F.col("word"))

    def patterns(frame: DataFrame, *columns: str) -> DataFrame:
        both = F.array(
            F.concat(F.lit("1 "), before(F.col("left"), 1)), F.concat(F.lit("2 "), before(F.col("left"), 2))
        )
        exploded = frame.select(*columns, F.explode(both).alias("pattern"))
        return exploded.filter("pattern IS NOT NULL")

    seen = patterns(seeds, "kind", "instance").groupBy("pattern", "kind", "instance").agg(
        F.lit(1.0).alias("score")
    )
    promising = seen.groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    promising = promising.filter(F.col("seeds") >= MIN_SEEDS)
    occurrences = stored(
        patterns(mentions, "digest", "start", "end", "instance", "word", "run").join(
            promising.select("pattern").distinct(), "pattern", "left_semi"
        ),
        "mentions",
    )
    known = stored(seen.join(promising.select("pattern", "kind"), ["pattern", "kind"]), "seeds")
    forms = [F.max(form).alias(form) for form in ("word", "run")]
    edges = occurrences.groupBy("pattern", "instance").agg(*forms)
    both = known.select("pattern", "instance", F.lit(True).alias("word"), F.lit(True).alias("run"))
    sizes = both.unionByName(edges).groupBy("pattern", "instance").agg(*forms)
    sizes = sizes.groupBy("pattern").agg(
        F.count_if("word").alias("words"), F.count_if("run").alias("runs")
    )
    instances = F.when(spaced, F.first("runs")).otherwise(F.first("words"))
    scores = known
    chosen = None
    for _ in range(rounds):
        share = F.sum("score") / (instances + DOUBT)
        scored = scores.join(sizes, "pattern").groupBy("pattern", "kind").agg(share.alias("confidence"))
        chosen = stored(scored.filter(F.col("confidence") >= CONFIDENCE), "patterns")
        believed = edges.join(chosen, "pattern").filter(fits).groupBy("instance", "kind").agg(
            F.max("confidence").alias("score")
        )
        new = edges.join(believed, "instance").filter(fits).select("pattern", "kind", "instance", "score")
        new = new.join(promising.select("pattern", "kind"), ["pattern", "kind"])
        scores = known.unionByName(new.join(known, ["pattern", "kind", "instance"], "left_anti"))
    best = F.max(F.struct("confidence", (-F.col("kind")).alias("kind")))
    spans = occurrences.join(chosen, "pattern").filter(fits).groupBy("digest", "start", "end").agg(best.alias("best"))
    span = F.struct("start", (-F.col("best.kind")).alias("kind"), "end")
    return stored(spans.groupBy("digest").agg(F.collect_list(span).alias("found")), "found")


def placed(column: str, kind: int) -> Column:
    return F.transform(
        column,
        lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
    )


def base_spans() -> Column:
    """All base spans of a scanned row as `start, kind, end`, in order."""
    each = [
        placed(k.name, i) for i, k in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*each))


def listed(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key, digest, base, spans`, both arrays of `start, kind, end`.

    `base` are the patterns' spans, leftmost and non-overlapping per kind, that pass their
    checks; `spans` adds what `discovered` found. Offsets count code points, the end is
    exclusive, `kind` numbers KINDS; order is by start, kind and end. A null text counts as
    empty. Repeated rows and null keys are like others; other columns are ignored. All of it is
    Spark expressions; text is scanned once and only spans and their contexts move.
    """
    rows = scanned(docs, key, text)
    found = discovered(rows)
    base = rows.select("key", "digest", base_spans().alias("base"))
    # Equal texts have one digest; adaptive execution splits a large group of them.
    joined = base.join(found, "digest", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    both = F.array_sort(F.concat("base", F.coalesce("found", none)))
    return joined.select(F.col("key").alias(key), "digest", "base", both.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first."""
    names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
    def step(state: Column, span: Column) -> tuple[Column, Column]:
        gap = F.substr(text, state["at"] + 1, span["start"] - state["at"])
        clear = span["start"] >= state["at"]
        parts = F.when(clear, F.array(gap, F.get(names, span["kind"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at")), parts

    def rest(state: Column) -> Column:
        return F.array(F.substr(text, state["at"] + 1, F.length(text)))

    parts = running(spans, F.struct(F.lit(0).alias("at")), "array<string>", step, rest)
    return F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(text)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with personal data replaced in `text`; all rows and columns stay.

    A null text stays null.
    """
    found = find_personal_data(docs, key, text).filter(F.size("spans") > 0)
    spans = found.select(F.col("digest").alias("__digest"), "spans").groupBy("__digest").agg(
        F.min("spans").alias("__spans")
    )
    marked = docs.withColumn("__digest", F.sha2(whole(text), 256)).join(spans, "__digest", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    new = redacted(F.col(text), F.coalesce("__spans", none))
    return marked.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])


@query()
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    rows = find_personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
