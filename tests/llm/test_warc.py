"""WARC files: round trip, canonical urls, and revisits against a loop over all responses."""

from datetime import datetime, timedelta

import pytest

from labelloom.llm import warc
from labelloom.plans.scratch import scratch_path

RECORDS = (
    "record_id string, kind string, url string, captured timestamp, profile string, status int, "
    f"headers {warc.HEADERS}, body binary, extra string"
)


@pytest.mark.parametrize(
    "url, want",
    [
        ("http://WWW.Example.org:80/A/?b=2&a=1&utm_source=x#top", "example.org/A?a=1&b=2"),
        ("https://example.org", "example.org"),
        ("https://example.org/", "example.org"),
        ("https://www2.example.org:8080/x?", "example.org:8080/x"),
        ("plain words ", "plain words"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "url string").select(warc.canonical_url("url"))
    assert df.first()[0] == want


def test_files_round_trip(spark):
    pages = spark.createDataFrame(
        [(n, f"http://h{n % 3}.org/{n}", f"<p>é {n}</p>\r\n\r\nx") for n in range(1, 25)] + [(30, None, None)],
        "page_id long, url string, html string",
    )
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.captures(pages), path)
    back = warc.read_warc(spark, path)
    full = {r["url"]: bytes(r["body"]).decode() for r in back.filter("status = 200").collect()}
    assert full == {
        (r["url"]): r["html"] or "" for r in pages.filter("page_id % 17 <> 0").collect()
    }
    assert back.filter("kind = 'malformed'").count() == 0
    assert back.filter("kind = 'revisit'").count() == 2 * pages.count()


def test_cut_off_record_is_malformed(spark):
    path = scratch_path(spark, "warc-cut")
    text = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nHTTP/1.1 200 OK\r\n\r\nshort"
    spark.createDataFrame([(text,)], "value string").write.text(path)
    assert [r["kind"] for r in warc.read_warc(spark, path).collect()] == ["malformed"]


def warc_text(number, body, version="1.1", tail="\r\n\r\n", more=0):
    block = f"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n{body}"
    return (
        f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: {number}\r\n"
        f"Content-Length: {len(block.encode()) + more}\r\n\r\n{block}{tail}"
    )


def read_back(spark, *texts):
    path = scratch_path(spark, "warc-read")
    frame = spark.createDataFrame([(t,) for t in texts], "value string").repartition(len(texts))
    frame.write.option("lineSep", "\n").text(path)
    rows = warc.read_warc(spark, path).collect()
    sound = {r["record_id"]: bytes(r["body"]).decode() for r in rows if r["kind"] == "response"}
    return sound, [(r["record_id"], bytes(r["body"]).decode()) for r in rows if r["kind"] == "malformed"]


def test_versions_and_marks_in_bodies(spark):
    inner = warc_text(99, "inside", "1.0")
    bodies = {
        "1": "é", "2": "a WARC/1.1\r\nline", "3": f"x{inner}{inner}y", "4": "WARC/1.WARC/1.0\r\n", "5": "",
        "6": inner,
    }
    for version in ("1.0", "1.1"):
        text = "".join(warc_text(n, b, version) for n, b in bodies.items())
        sound, malformed = read_back(spark, text[:-1])
        assert sound == bodies and malformed == []


def test_unread_bytes_and_cut_records(spark):
    text = (
        warc_text(1, "a") + warc_text(2, "cut", more=50) + warc_text(3, "c")
        + warc_text(4, "d", tail="junk\r\n\r\n") + warc_text(5, "e")
    )
    sound, malformed = read_back(spark, text[:-1])
    assert sound == {"1": "a", "3": "c", "4": "d", "5": "e"}
    assert sorted(malformed, key=str) == [("2", "cut\r\n\r\n"), (None, "junk\r\n\r\n")]


def record(n, kind, url, minute, etag=None, modified=None, extra=()):
    fields = [("etag", etag), ("last-modified", modified), *extra]
    headers = [(k, v) for k, v in fields if v is not None]
    at = None if minute is None else datetime(2024, 1, 1) + timedelta(minutes=minute)
    revisit = kind == "revisit"
    return (
        f"r{n:03}", kind, url, at, warc.NOT_MODIFIED if revisit else None, 304 if revisit else 200,
        headers, None if revisit else bytes([n]), "x",
    )


def test_resolution(spark):
    url, other = "http://a.org/x", "https://www.a.org/x/"
    stored = [("server", "s"), ("cache-control", "old")]
    rows = [
        record(1, "response", url, 0, '"a"', extra=stored),
        record(2, "revisit", other, 5, 'W/"a"', extra=[("cache-control", "new"), ("server", "t")]),
        record(3, "revisit", url, 0, '"a"'),  # not strictly later
        record(4, "response", other, 10, '"b"'),
        record(5, "revisit", url, 11, '"a"'),  # the latest response has changed
        record(6, "revisit", url, 5000, '"b"'),  # days later
        record(7, "revisit", url, 12),  # nothing to compare
        record(8, "revisit", "http://b.org/", 12, '"b"'),
        record(9, "revisit", None, 12, '"b"'),
        record(10, "revisit", url, None, '"b"'),
        record(11, "response", "http://c.org/", 1, None, "Mon"),
        record(12, "revisit", "http://c.org/", 2, '"c"', "Mon"),
        record(12, "revisit", "http://c.org/", 2, '"c"', "Mon"),  # a repeated row
    ]
    got = warc.resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect()
    found = {r["record_id"]: (r["resolution"], r["refers_to"]) for r in got}
    assert len(got) == 10 and found == {
        "r002": ("resolved", "r001"), "r003": ("missing", None), "r005": ("mismatch", "r004"),
        "r006": ("resolved", "r004"), "r007": ("unverified", "r004"), "r008": ("missing", None),
        "r009": ("missing", None), "r010": ("missing", None), "r012": ("resolved", "r011"),
    }
    merged = {r["record_id"]: dict(map(tuple, r["headers"])) for r in got}["r002"]
    assert merged == {"server": "s", "etag": 'W/"a"', "cache-control": "new"}
    assert warc.resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0


def test_one_url_with_most_records(spark):
    """Every bucket width gives what a loop over all earlier responses gives."""
    rows = []
    for n in range(400):
        kind = "response" if n % 7 == 0 else "revisit"
        rows.append(record(n % 250, kind, "http://hot.org/", (n * 37) % 3000, f'"{n % 5}"'))
    responses = [r for r in rows if r[1] == "response"]
    want = []
    for r in rows:
        if r[1] == "revisit":
            early = [(s[3], s[0]) for s in responses if s[3] < r[3]]
            want.append((r[0], r[3], max(early)[1] if early else None))
    df = spark.createDataFrame(rows, RECORDS)
    for seconds in (600, 86_400, 10**9):
        got = warc.resolve_revisits(df, bucket_seconds=seconds)
        assert sorted(
            ((r["record_id"], r["captured"], r["refers_to"]) for r in got.collect()), key=str
        ) == sorted(want, key=str)


def test_page_without_id(spark):
    """As in REVISITS_SQL: two revisits, without time or response."""
    pages = spark.createDataFrame(
        [(None, "http://h.org/a", "x"), (1, "http://h.org/a", "x")], "page_id long, url string, html string"
    )
    path = scratch_path(spark, "warc-null")
    warc.write_warc(warc.captures(pages), path)
    got = warc.shown(warc.resolve_revisits(warc.read_warc(spark, path))).collect()
    assert sorted(tuple(r) for r in got if r["page_id"] is None) == [
        (None, n, "h.org/a", None, None, "missing", f"cache-control: max-age={n * 60}\nserver: s{n}", None)
        for n in (1, 2)
    ]
    assert [r["resolution"] for r in got if r["page_id"] == 1] == ["resolved", "resolved"]
