"""WARC archives and their index against brute force."""

import collections
import glob
import gzip
import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.llm import queries, warc

BIG = "<p>" + "long page é " * 200
PAGES = [
    (1, "http://www.a.com/x?B=1#top", BIG), (2, "https://a.com:8080/x?b=1", BIG), (3, "http://b.a.com", BIG), (4, "http://a.com/", "short"), (5, "http://a.com/", "short"),
    (6, None, None), (7, "", ""), (8, "no url\r\nat all", BIG), (8, "http://c.de/ü b", BIG), (9, "http://c.de/", BIG + "2"), (9, "http://c.de/", BIG + "2"), (None, "http://n.de/", BIG),
    (None, None, "lost"), (2**53 + 1, "http://big.org/", "x" * 999), (2**53 + 3, "http://big.org/", "x" * 999), (10, "http://user@D.com/", "y" * 1000), (11, "http://d.com/", "y" * 1000), (12, "ftp://d.com?q", "\r\n\r\nWARC/1.1\r\n\x00🙂"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload_digest string, seconds int")


def expected(rows):
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    out = []
    for i, url, html in rows:
        raw = (html or "").encode()
        back = largest.get(html or "") if i is not None and len(raw) >= 1000 and i < largest[html or ""] else None
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if back is None else "revisit", back))
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or COLUMNS)).collect()), key=str)


def test_report_is_brute_force_and_archives_are_warc(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    got = warc.archive_report(pages(spark), folder).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == expected(PAGES)
    assert sorted(r["position"] for r in got) == list(range(len(PAGES)))
    order = sorted(got, key=lambda r: r["position"])
    assert [r["urlkey"] for r in order] == sorted(r["urlkey"] for r in got)
    assert {r["urlkey"] for r in got if r["page_id"] in (1, 2, 3)} == {"com,a)/x?b=1", "com,a,b)/"}
    # Without the index, from the files alone.
    scanned = warc.scan_archives(spark, folder)
    assert plain(scanned) == sorted(((None if i is None else str(i), n, d, t, None if b is None else str(b)) for i, n, d, t, b in expected(PAGES)), key=str)
    texts = {r["page_id"]: bytes(r["html"]).decode() for r in scanned.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert texts["12"] == PAGES[-1][2] and texts["6"] == "" and texts["8"] == BIG
    first = gzip.open(glob.glob(f"{tmp_path}/w/*.warc.gz")[0]).read()
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_empty_table_and_very_long_page(spark):
    assert warc.archive_report(pages(spark, [])).count() == 0
    rows = [(k, "http://a.com/", "z" * 20_000_000 + str(k % 2)) for k in range(4)]
    assert plain(warc.archive_report(pages(spark, rows))) == expected(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 32])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(50), rng.randrange(5)) for _ in range(rng.randrange(40))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(itertools.chain(*runs))


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_histories_are_globally_ordered(spark, ranges):
    rng = random.Random(3)
    every, rows = [], []
    for run in range(12):
        # A third of all captures is of one URL.
        entries = sorted((rng.choice(["hot", "hot", *[f"u{k}" for k in range(40)]][: 2 if rng.random() < 0.3 else None]), f"2020{rng.randrange(5000):010d}", rng.randrange(10**6), f"f{run}", 100 * n, 100, "response") for n in range(rng.randrange(1, 300)))
        every += entries
        rows.append((f"f{run}", len(entries), [e[:3] for e in entries[:: max(1, len(entries) // 32)]], bytearray(warc._pack(entries))))
    index = warc.merged_index(spark.createDataFrame(rows, warc.RUN), ranges)
    got = [tuple(r) for r in warc.histories(index).orderBy("position").collect()]
    seen, want = collections.Counter(), []
    for n, e in enumerate(sorted(every)):
        want.append((n, seen[e[0]], *e))
        seen[e[0]] += 1
    assert got == want
    if ranges == 40:
        sizes = [r["n"] for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 6 * len(every) / ranges  # the hot URL is dealt out too


def test_damaged_payload_is_an_error():
    good = warc.record_bytes("1", "http://a.com/", b"abc", 3, hashlib.sha1(b"abc").hexdigest(), 0, None)
    assert warc.record_row(good)[:6] == ("1", "http://a.com/", 3, hashlib.sha1(b"abc").hexdigest(), "response", None)
    for bad in (good.replace(b"abc", b"abd"), good[:-5], b"x" + good):
        with pytest.raises(ValueError):
            warc.record_row(bad)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet')")
    found = con.execute(queries.ORACLE_SQL["op13_warc_archives"])
    columns = [d[0] for d in found.description]
    assert plain(queries.QUERIES["op13_warc_archives"](spark, folder), *columns) == sorted(found.fetchall(), key=str)
