"""WARC files and the resolution of not-modified revisits to the response they stand for."""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from labelloom.llm.common import stored, table, whole
from labelloom.llm.registry import query
from labelloom.plans.scratch import scratch_path

# Fixed values of the formats.
VERSION = "WARC/1.1\r\n"
MARK = "WARC/1."  # what the versions that are read begin with
CRLF = "\r\n"
VERSIONS = ("0" + CRLF, "1" + CRLF)  # what follows the mark where a record begins
NOT_MODIFIED = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
# Header fields that a 304 answer may bring up to date; all others stay as stored.
PERMITTED = "cache-control content-location date etag expires last-modified vary".split()
# Query parameters that name a visit, not a page.
TRACKING = r"^(utm_[a-z]+|ref|sessionid|sid|phpsessid|fbclid|gclid)="

HEADERS = "array<struct<name:string,value:string>>"
DAY = 86_400


def canonical_url(url: str | Column) -> Column:
    """One spelling for the urls of a page; null for null.

    Scheme, `www.`, default ports, fragment, tracking parameters and a closing slash go; the
    host is in lower case and the parameters are sorted. A text without `://` is only trimmed.
    """
    url = F.trim(F.col(url) if isinstance(url, str) else url)
    bare = F.substring_index(url, "#", 1)
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\d*\.", ""), r":(80|443)$", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(path, r"/+$", "")
    given = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(given, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    search = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
    return F.when(
        F.contains(bare, F.lit("://")), F.concat(host, path, F.coalesce(search, F.lit("")))
    ).otherwise(bare)


def record_text(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A WARC record: version, header fields (null ones left out), empty line, block."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    head = F.concat(*[F.coalesce(line, F.lit("")) for line in lines])
    return F.concat(F.lit(VERSION), head, length, F.lit(CRLF * 2), block)


def write_warc(records: DataFrame, path: str, column: str = "record") -> None:
    """Write record texts as compressed WARC files, one per task."""
    # The line separator is the pair of line ends that closes every record.
    writer = records.select(column).write.option("lineSep", CRLF * 2)
    writer.option("compression", "gzip").text(path)


def fields_of(head: Column) -> Column:
    """`name: value` lines as an array of fields, names in lower case, in order, repeats kept."""
    lines = F.filter(F.split(head, CRLF), lambda line: F.instr(line, ":") > 1)
    return F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.trim(F.substr(line, F.instr(line, ":") + 1)).alias("value"),
        ),
    )


def field(fields: str | Column, name: str) -> Column:
    """The first value of a field; null where it is absent."""
    fields = F.col(fields) if isinstance(fields, str) else fields
    return F.get(F.filter(fields, lambda f: f["name"] == name), F.lit(0))["value"]


def declared(piece: Column) -> Column:
    """Bytes of the record that begins with this piece, by its Content-Length; null where none does."""
    head = F.substring_index(piece, CRLF * 2, 1)
    begins = F.substr(piece, F.lit(1), F.lit(3)).isin(*VERSIONS) & (F.instr(piece, CRLF * 2) > 0)
    length = field(fields_of(head), "content-length").try_cast("long")
    return F.when(begins & (length >= 0), F.octet_length(head) + 4 + length).cast("long")


def numbered(pieces: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one file with the number of the record each belongs to.

    `size` is a piece's length, `need` what `declared` says. A record takes the pieces after it
    up to its length if it then ends where a piece does. Else it was cut off: it stays alone, and
    the next piece may begin a record. A piece that begins none has `stray`.
    """
    pieces = pieces.sort_values(["block", "id"], ignore_index=True)
    ends = list(accumulate(int(n) + len(MARK) for n in pieces["size"]))  # each with a mark before it
    need = [None if pd.isna(n) else int(n) for n in pieces["need"]]
    records, i = [], 0
    while i < len(ends):
        last = i
        if need[i] is not None:
            end = (ends[i - 1] if i else 0) + len(MARK) + need[i]
            j = bisect_left(ends, end, lo=i)
            # Behind a record are two line ends; the last one of a file may lack them.
            if j < len(ends) and (ends[j] - end == 4 or j == len(ends) - 1 and ends[j] - end < 4):
                last = j
        records += [i] * (last + 1 - i)
        i = last + 1
    pieces["record"] = records
    pieces["stray"] = [need[r] is None for r in records]
    return pieces[["file", "block", "id", "record", "stray"]]


def joined(pieces: DataFrame) -> DataFrame:
    """`value, stray`: the records of files in which some are not one piece each."""
    slim = pieces.select(
        "file", "block", "id", F.octet_length("value").cast("long").alias("size"),
        declared(F.col("value")).alias("need"),
    )
    # What one task holds of a file are two numbers a piece, no text.
    numbers = slim.groupBy("file").applyInPandas(
        numbered, "file string, block long, id long, record long, stray boolean"
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "value")))
    records = pieces.join(numbers, ["file", "block", "id"]).groupBy("file", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), MARK).alias("value"),
        F.first("stray").alias("stray"),
    )
    return records.filter("value <> ''").select("value", "stray")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: `record_id, kind, url, captured, profile, status, headers, body`.

    Files of version 1.0 and 1.1 are split at the versions' common mark; plain ones are split and
    compressed ones streamed piece by piece, so a file's size doesn't matter. The body is binary, cut
    by Content-Length. A first pass looks for files in which a piece is not just one record; in
    these, pieces are put together by Content-Length, so a body may hold the mark. A record that is
    shorter than it says has kind `malformed`, with whatever fields could be read. So have
    bytes that belong to no record; those behind a record are the `body` of a row of their own.
    """
    raw = spark.read.option("lineSep", MARK).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),  # in order within a block
    )
    one = (F.octet_length("value") == declared(F.col("value")) + 4) & F.endswith(
        F.col("value"), F.lit(CRLF * 2)
    )
    odd = raw.filter((F.col("value") != "") & ~F.coalesce(one, F.lit(False)))
    files = [r["file"] for r in odd.select("file").distinct().collect()]
    plain = raw.filter("value <> ''")
    if not files:
        return parsed(plain.select("value", F.lit(False).alias("stray"))).drop("unread")
    plain = plain.filter(~F.col("file").isin(files)).select("value", F.lit(False).alias("stray"))
    # Written once, so that a piece has the same number wherever it is used.
    pieces = stored(raw.filter(F.col("file").isin(files)), "warc-pieces")
    records = parsed(plain.unionByName(joined(pieces)))
    unread = records.filter(~F.col("unread").isin(b"", b"\r\n", b"\r\n\r\n")).select(
        *[
            F.lit("malformed").alias(name) if name == "kind"
            else F.array().cast(kind).alias(name) if name == "headers"
            else F.col("unread").alias(name) if name == "body"
            else F.lit(None).cast(kind).alias(name)
            for name, kind in records.drop("unread").dtypes
        ]
    )
    return records.drop("unread").unionByName(unread)


def parsed(records: DataFrame) -> DataFrame:
    """The columns of `read_warc` from `value, stray`, and the bytes behind the block, `unread`."""
    end = F.instr("value", CRLF * 2)
    parts = records.select(
        "stray", fields_of(F.substring_index("value", CRLF * 2, 1)).alias("fields"),
        F.when(end > 0, F.substr("value", end + 4)).cast("binary").alias("rest"),
    )
    length = field("fields", "content-length").try_cast("int")
    cut = parts.withColumn("length", length).withColumn(
        "block", F.substr("rest", F.lit(1), F.col("length"))
    )
    text = F.decode("block", "ISO-8859-1")  # one character per byte: offsets stay true
    http_end = F.instr(text, CRLF * 2)
    head = F.when(http_end > 0, F.substr(text, F.lit(1), http_end - 1)).otherwise(text)
    whole_record = (
        ~F.col("stray") & F.col("length").isNotNull() & (F.octet_length("block") == F.col("length"))
    )
    return cut.select(
        field("fields", "warc-record-id").alias("record_id"),
        F.when(whole_record, field("fields", "warc-type")).otherwise("malformed").alias("kind"),
        field("fields", "warc-target-uri").alias("url"),
        F.try_to_timestamp(field("fields", "warc-date")).alias("captured"),
        field("fields", "warc-profile").alias("profile"),
        F.regexp_extract(head, r"^HTTP/\S+ (\d{3})", 1).try_cast("int").alias("status"),
        fields_of(head).alias("headers"),
        F.when(http_end > 0, F.substr("block", http_end + 4, F.lit(2**31 - 1)))
        .otherwise(F.lit(b""))
        .alias("body"),
        F.when(whole_record, F.substr("rest", F.col("length") + 1, F.lit(2**31 - 1))).alias("unread"),
    )


def merged_headers(old: Column, fresh: Column) -> Column:
    """Stored fields, with those that the 304 answer may update taken from it."""
    allowed = F.filter(fresh, lambda f: f["name"].isin(PERMITTED))
    names = F.transform(allowed, lambda f: f["name"])
    kept = F.filter(old, lambda f: ~F.array_contains(names, f["name"]))
    return F.concat(kept, allowed)


def resolve_revisits(records: DataFrame, bucket_seconds: int = DAY) -> DataFrame:
    """Each not-modified revisit with the latest earlier full response of its canonical url.

    `records` has the columns of `read_warc`. Returns `record_id, canonical, captured,
    refers_to, resolution, headers, digest`. A full response has status 200. `resolution`:

    * `resolved`: the validators agree (entity tags, compared weakly, else Last-Modified);
      `headers` are the stored ones with the permitted updates, `digest` is of the stored body;
    * `mismatch`: they differ; `unverified`: there is none to compare; `missing`: no
      earlier response. Then `headers` are the revisit's own and `digest` is null.

    Only strictly earlier responses count; of several at one time, the largest record id.
    A revisit without url or time is `missing`. Repeated rows give repeated rows.

    The as-of join has no large group: a url's records are ordered within time buckets,
    and what a bucket starts from comes from a window over one row per url and bucket. Bodies
    are left behind before anything is shuffled.
    """
    micros = F.unix_micros("captured")
    response = (F.col("kind") == "response") & (F.col("status") == 200)
    revisit = (F.col("kind") == "revisit") & F.coalesce(
        (F.col("profile") == NOT_MODIFIED) | (F.col("status") == 304), F.lit(False)
    )
    narrow = records.filter(response | revisit).select(
        "record_id", "captured", "headers",
        canonical_url("url").alias("canonical"),
        micros.alias("at"),
        F.floor(micros / (bucket_seconds * 1_000_000)).alias("bucket"),
        revisit.alias("revisit"),
        F.when(
            response & micros.isNotNull(),
            F.struct(micros.alias("at"), "record_id", F.sha2("body", 256).alias("digest"), "headers"),
        ).alias("response"),
    )
    # Both uses below read these narrow rows, so the files are parsed once.
    slim = stored(narrow, "warc-visits")
    ends = slim.groupBy("canonical", "bucket").agg(F.max("response").alias("end"))
    before = Window.partitionBy("canonical").orderBy("bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    # One row per url and bucket: as many as the archive has buckets of time.
    carried = ends.select(
        "canonical", "bucket", F.last("end", ignorenulls=True).over(before).alias("carried")
    )
    earlier = Window.partitionBy("canonical", "bucket").orderBy("at")
    earlier = earlier.rangeBetween(Window.unboundedPreceding, -1)
    seen = slim.withColumn("inside", F.max("response").over(earlier)).filter("revisit")
    joined = seen.join(carried, ["canonical", "bucket"], "left")
    found = joined.withColumn("found", F.coalesce("inside", "carried"))

    def tag(headers: Column) -> Column:
        return F.regexp_replace(field(headers, "etag"), "^W/", "")

    kept = F.col("found.headers")
    tags = tag(kept) == tag(F.col("headers"))
    dates = field(kept, "last-modified") == field("headers", "last-modified")
    agree = F.coalesce(tags, dates)
    usable = F.col("canonical").isNotNull() & F.col("at").isNotNull() & F.col("found").isNotNull()
    resolution = (
        F.when(~usable, "missing")
        .when(agree.isNull(), "unverified")
        .when(agree, "resolved")
        .otherwise("mismatch")
    )
    good = F.col("resolution") == "resolved"
    return found.withColumn("resolution", resolution).select(
        "record_id", "canonical", "captured",
        F.when(F.col("resolution") != "missing", F.col("found.record_id")).alias("refers_to"),
        "resolution",
        F.when(good, merged_headers(kept, F.col("headers")))
        .otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("found.digest")).alias("digest"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """A crawl of the pages as WARC record texts: a response each and two later revisits.

    Every seventeenth page lost its response, every tenth changed between the visits, every
    tenth sends no entity tag, every tenth sends no validator. Pages whose urls differ only in
    spelling share one history. A page without id has two revisits without time or validators.
    """
    http_date = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
    html = whole("html")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 7)
    steps = F.when(F.col("page_id") % 17 != 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1), F.lit(2))
    )
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.md5(html).alias("md5"), at.alias("base"),
        F.explode(steps).alias("step"),
    )
    rest = F.col("page_id") % 10
    changed = (rest == 3) & (F.col("step") == 2)
    tag = F.when(rest < 8, F.concat(
        F.when(rest == 5, "W/").otherwise(""), F.lit('"'), F.substring("md5", 1, 16),
        F.when(changed, "-2").otherwise(""), F.lit('"'),
    ))
    modified = F.when(rest != 9, F.date_format(F.col("base") - F.expr("INTERVAL 3 DAYS"), http_date))
    captured = F.col("base") + F.make_dt_interval(F.col("step") * 2, F.col("page_id") % 5)
    full = F.col("step") == 0

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    block = F.concat(
        F.when(full, "HTTP/1.1 200 OK\r\n").otherwise("HTTP/1.1 304 Not Modified\r\n"),
        line("Date", F.date_format(captured, http_date)),
        line("ETag", tag),
        line("Last-Modified", modified),
        line("Cache-Control", F.concat(F.lit("max-age="), (F.col("step") * 60).cast("string"))),
        line("Server", F.concat(F.lit("s"), F.col("step").cast("string"))),
        line("Content-Type", F.when(full, "text/html; charset=utf-8")),
        line("Content-Length", F.when(full, F.octet_length("html").cast("string"))),
        F.lit(CRLF),
        F.when(full, F.col("html")).otherwise(""),
    )
    name = F.concat_ws(":", F.lit("<urn:page"), "page_id", F.concat("step", F.lit(">")))
    fields = [
        ("WARC-Type", F.when(full, "response").otherwise("revisit")),
        ("WARC-Record-ID", name),
        ("WARC-Date", F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Profile", F.when(~full, NOT_MODIFIED)),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    return rows.select(record_text(fields, block).alias("record"))


CANONICAL_SQL = r"""
    SELECT page_id, coalesce(html, '') AS html, CASE WHEN contains(bare, '://') THEN
        regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\d*\.', ''), ':(80|443)$', '')
        || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN len(given) > 0 THEN '?' || array_to_string(given, '&') ELSE '' END
        ELSE bare END AS canonical
    FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
              lambda p: p <> '' AND NOT regexp_matches(lower(p),
                  '^(utm_[a-z]+|ref|sessionid|sid|phpsessid|fbclid|gclid)='))) AS given
          FROM (SELECT *, regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
                FROM (SELECT *, split_part(trim(url), '#', 1) AS bare FROM pages)))
"""
SHOWN_DATE = "strftime({0}, '%a, %d %b %Y %H:%M:%S GMT')"
REVISITS_SQL = f"""
WITH c AS ({CANONICAL_SQL}), visit AS (
    SELECT *, make_timestamp((1700000000 + page_id * 7) * 1000000) AS base,
           page_id % 10 AS rest, unnest([0, 1, 2]) AS step FROM c
), v AS (
    SELECT *, base + to_days((step * 2)::INTEGER) + to_hours(page_id % 5) AS captured,
           CASE WHEN rest < 8 THEN CASE WHEN rest = 5 THEN 'W/' ELSE '' END || '"' || left(md5(html), 16)
                || CASE WHEN rest = 3 AND step = 2 THEN '-2' ELSE '' END || '"' END AS tag,
           CASE WHEN rest <> 9 THEN {SHOWN_DATE.format("base - to_days(3)")} END AS modified
    FROM visit WHERE step > 0 OR page_id % 17 <> 0
), h AS (
    SELECT *, {SHOWN_DATE.format("captured")} AS date FROM v
), pair AS (
    SELECT r.*, s.page_id AS response_page_id, s.tag AS s_tag, s.modified AS s_modified, s.html AS s_html,
           row_number() OVER (PARTITION BY r.page_id, r.step
                              ORDER BY s.captured DESC NULLS LAST, '<urn:page:' || s.page_id || ':0>' DESC) AS nth
    FROM (SELECT * FROM h WHERE step > 0) r
    LEFT JOIN (SELECT * FROM h WHERE step = 0) s ON r.canonical = s.canonical AND s.captured < r.captured
), judged AS (
    SELECT *, coalesce(replace(tag, 'W/', '') = replace(s_tag, 'W/', ''), modified = s_modified) AS agree
    FROM pair WHERE nth = 1
), named AS (
    SELECT *, CASE WHEN response_page_id IS NULL THEN 'missing' WHEN agree IS NULL THEN 'unverified'
                   WHEN agree THEN 'resolved' ELSE 'mismatch' END AS resolution FROM judged
)
SELECT page_id, step::BIGINT AS visit, canonical, captured, response_page_id, resolution,
       array_to_string(list_filter(list_concat(
           CASE WHEN resolution = 'resolved' THEN [
               CASE WHEN tag IS NULL THEN 'etag: ' || s_tag END,
               CASE WHEN modified IS NULL THEN 'last-modified: ' || s_modified END,
               'server: s0', 'content-type: text/html; charset=utf-8',
               'content-length: ' || strlen(s_html)] ELSE []::VARCHAR[] END,
           ['date: ' || date, 'etag: ' || tag, 'last-modified: ' || modified, 'cache-control: max-age=' || step * 60],
           CASE WHEN resolution = 'resolved' THEN []::VARCHAR[] ELSE ['server: s' || step] END
       ), lambda x: x IS NOT NULL), chr(10)) AS headers,
       CASE WHEN resolution = 'resolved' THEN sha256(s_html) END AS body_sha256
FROM named
"""


def shown(resolved: DataFrame) -> DataFrame:
    """The columns of REVISITS_SQL from resolved revisits of `captures`."""
    number = F.regexp_extract("record_id", r":(\d+):(\d+)>", 1).try_cast("long")
    target = F.regexp_extract("refers_to", r":(\d+):(\d+)>", 1).try_cast("long")
    lines = F.transform("headers", lambda f: F.concat_ws(": ", f["name"], f["value"]))
    return resolved.select(
        number.alias("page_id"),
        F.regexp_extract("record_id", r":(\d+)>$", 1).cast("long").alias("visit"),
        "canonical", "captured", target.alias("response_page_id"), "resolution",
        F.array_join(lines, "\n").alias("headers"), F.col("digest").alias("body_sha256"),
    )


@query(sql=REVISITS_SQL)
def op10_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' crawl, written as WARC files and read back: every revisit and what it stands for."""
    path = scratch_path(spark, "warc")
    write_warc(captures(table(spark, sf_dir, "pages")), path)
    return shown(resolve_revisits(read_warc(spark, path)))
