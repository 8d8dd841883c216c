from __future__ import annotations

import datetime as dt
import random
import tracemalloc

import pytest
from brute import warc_rows
from pyspark.sql import functions as F

from vendaflow.llm import urls, warc

PAGES = "page_id bigint, url string, html string, digest string, first bigint"


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", 9) for p, u, h in rows], PAGES).repartition(3)


def some_pages() -> list[tuple]:
    pick = random.Random(3)
    parts = [warc.BETWEEN, "\r\n", "WARC/1.1", "é", "🎉", "abc", "\r", "\n", "Content-Length: 5\r\n\r\n", warc.VERSION]
    rows = [(i, f"http://h/{i}", "".join(pick.choice(parts) for _ in range(pick.randint(0, 30)))) for i in range(80)]
    rows += [(100, None, None), (101, "bad\r\nurl \r\n\r\nWARC/1.1\r\n", ""), (102, "http://h", "x" * 300_000)]
    return rows + [(103, "http://h", "x" * 300_000), (104, "http://h", rows[5][2]), (None, "http://h", "x"), (105, "", "x")]


def archived(spark, rows, path, **options):
    warc.write_archives(pages(spark, rows), path, **options)
    return sorted(map(tuple, warc.read_records(spark, path).collect()), key=str)


def test_round_trip(spark, tmp_path):
    rows = some_pages()
    wanted = sorted(warc_rows([(p, h) for p, _, h in rows]), key=str)
    for chunk in (32, 1000, warc.CHUNK_BYTES):
        assert archived(spark, rows, str(tmp_path / str(chunk)), chunk_bytes=chunk) == wanted


def test_payloads_from_chunks(spark, tmp_path):
    rows, path = some_pages(), str(tmp_path / "warc")
    warc.write_archives(pages(spark, rows), path, chunk_bytes=1000)
    chunks = warc.read_chunks(spark, path)
    assert chunks.agg(F.max(F.length("chunk"))).first()[0] <= 1000 + 200
    whole: dict[str, list] = {}
    for r in chunks.filter("record_type = 'response'").collect():
        whole.setdefault(r.record_id, []).append((r.chunk_no, bytes(r.chunk)))
    payloads = {k: b"".join(c for _, c in sorted(v)) for k, v in whole.items()}
    for p, _, h in rows:
        name = f"urn:page:{'' if p is None else p}"
        if name in payloads:
            assert payloads[name] == (h or "").encode()


def test_segments_of_another_record_are_an_error(spark, tmp_path):
    """Origin, number and total length are looked at, not the digest alone."""
    html = "abcdefgh" * 20
    wanted = list(warc.page_records(1, "http://a.b/", html, None, 64))
    assert len(wanted) == 3
    for k, (old, new) in enumerate((
        ("Origin-ID: <urn:page:1>", "Origin-ID: <urn:page:2>"), ("Segment-Number: 2", "Segment-Number: 3"),
        ("Total-Length: ", "Total-Length: 1"), ("", ""),
    )):
        path = tmp_path / str(k)
        path.mkdir()
        text = "".join(r + "\n" for r in wanted)
        assert old in text
        (path / "a.txt").write_bytes(text.replace(old, new).encode())
        if old:
            with pytest.raises(Exception, match="segment"):
                warc.read_records(spark, str(path)).collect()
        else:
            assert warc.read_records(spark, str(path)).first().payload_bytes == 160


def test_a_payload_is_held_once_when_cut():
    html = "0123456789abcdef" * (1 << 19)
    tracemalloc.start()
    n = sum(1 for _ in warc.page_records(1, "http://a.b/", html, None, warc.CHUNK_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 128 and peak < 1.5 * len(html)


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (3, "u", "abc")]
    found = archived(spark, rows, str(tmp_path / "w"), least_bytes=3)
    assert [(r[0], r[3], r[4]) for r in found] == [
        (1, "response", None), (2, "response", None), (3, "response", None), (3, "response", None),
        (4, "revisit", 3),
    ]


def test_no_pages(spark, tmp_path):
    assert archived(spark, [], str(tmp_path / "none")) == []


def changes(spark, rows):
    day = dt.date(2020, 1, 1)
    return spark.createDataFrame(
        [(n, p, v, None if d is None else day + dt.timedelta(d), on) for n, p, v, d, on in rows],
        "list_name string, pattern string, verdict string, changed_on date, listed boolean",
    )


def judged(spark, captures, log):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame(
        [(p, u, None if d is None else day + dt.timedelta(d), "x", "y") for p, u, d in captures],
        "page_id bigint, url string, fetched_on date, pattern string, verdict string",
    )
    found = urls.judge(df, urls.intervals(changes(spark, log)))
    return sorted(((r.page_id, r.verdict, r.pattern, r.list_name) for r in found.collect()), key=str)


LOG = [
    ("a", "example.com", "block", 10, True),
    ("a", "example.com", "block", 20, False),
    ("a", "Example.com", "block", 30, True),
    ("a", "www.example.com/Good", "allow", 0, True),
    ("b", "www.example.com", "allow", 12, True),
    ("a", "www.example.com", "block", 12, True),
    ("a", "gone.org", "block", 5, True),
    ("a", "gone.org", "block", 5, False),
    (None, "x.org", "block", 0, True),
    ("a", None, "block", 0, True),
    ("a", "x.org", "block", None, True),
]


def test_entries_active_when_fetched(spark):
    url = "http://sub.example.com/"
    days = [(i, url, d) for i, d in enumerate([9, 10, 19, 20, 29, 30, 4000])]
    found = [r[1] for r in judged(spark, days, LOG)]
    assert found == ["none", "block", "block", "none", "none", "block", "block"]


def test_the_longest_pattern_decides(spark):
    rows = [
        (1, "https://user@www.Example.com:80/good/x?q#f", 15), (2, "https://www.example.com/goodness", 15),
        (3, "https://www.example.com", 15), (4, "https://example.com.evil.org/", 15), (5, None, 15),
        (6, "https://example.com", None), (7, "no url", 15), (None, "https://example.com/a//b", 15),
        (9, "http://gone.org", 6), (9, "http://gone.org", 6), (10, "http://x.org", 6), (11, "", 6),
    ]
    found = {(r[0], r[1], r[2], r[3]) for r in judged(spark, rows, LOG)}
    assert found == {
        (1, "allow", "www.example.com/good", "a"), (2, "block", "www.example.com", "a"),
        (3, "block", "www.example.com", "a"), (4, "none", None, None), (5, "none", None, None),
        (6, "none", None, None), (7, "none", None, None), (None, "block", "example.com", "a"),
        (9, "block", "gone.org", "a"), (10, "none", None, None), (11, "none", None, None),
    }


def test_common_hosts_are_spread(spark):
    rows = [(i, f"http://www.example.com/{i}", 15) for i in range(2000)]
    assert {r[1] for r in judged(spark, rows, LOG)} == {"block"}
    assert judged(spark, [], LOG) == [] and judged(spark, rows[:1], []) == [(0, "none", None, None)]


def test_no_python_in_the_plan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = urls.judge(urls.dated_captures(table), urls.intervals(urls.list_changes(table)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
