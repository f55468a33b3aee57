"""WARC round trips, with version lines inside payloads and across splits."""

import base64
import hashlib
import random

import numpy as np
import pytest

from adlake.llm import queries, warc
from adlake.session import scratch_dir


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def brute(rows, least=0):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            first[b] = min(first.get(b, 1 << 60), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and first.get(b, i) < i
        out.append((i, len(b), digest(b), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages():
    rnd = random.Random(1)
    rows = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "x\r\ny", ""), (5, "u", FAKE), (6, "u", "abc" + FAKE * 3 + "WARC/1.1\r\n"), (7, "u", "WARC/1.1\r\n")]
    rows += [(None, "u", "abc"), (8, "u", "abc"), (9, "u", "abc"), (9, "u", "abc"), (10, "u", "z" * 5000 + "\nWARC/1.1\r\n" + "q" * 3000), (11, "q", "\r\n\r\n"), (12, "q", FAKE)]
    return rows + [(100 + i, f"u{i}", "".join(rnd.choice(["ab\n", "é", "WARC/1.1", "\r\n", "x" * 50]) for _ in range(rnd.randint(0, 60)))) for i in range(200)]


@pytest.mark.parametrize(("least", "split", "per_file"), [(0, "128m", 20_000), (2, "3000", 20_000), (0, "777", 40)])
def test_round_trip(spark, least, split, per_file):
    rows = pages()
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3), path, min_bytes=least, records_per_file=per_file)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = warc.read_archives(spark, path, with_payload=True).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got), key=str) == brute(rows, least)
    texts = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got if r.type == "response" and r.page_id is not None)


def test_empty_table(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_reachable():
    start = np.array([0, 10, 15, 40, 60])
    assert warc.reachable(start, np.array([10, 40, 60, 60, 99])).tolist() == [True, True, False, True, True]
    assert warc.reachable(start, np.array([11, 40, 60, 60, 99])).tolist() == [True, False, False, False, False]
    assert warc.reachable(start, np.array([-1, 40, 60, 60, 99])).tolist() == [True, False, False, False, False]


def test_query(spark, sf_small):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op7_warc_round_trip"](spark, sf_small).collect()), key=str) == brute(rows)


def test_urls_that_end_like_a_version_line(spark):
    urls = ["http://a/WARC/1.1", "WARC/1.1", "http://b/WARC/1.1\r\n", "WARC/1.1/WARC/1.1", "http://c/WARC/1x1", "http://d", "WARC/1.1 x"]
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(i, u, f"p{i % 5}") for i, u in enumerate(urls)], "page_id long, url string, html string").coalesce(1), path)
    got = {r.page_id: r for r in warc.read_archives(spark, path, with_payload=True).collect()}
    assert {i: r.uri for i, r in got.items()} == {i: u.strip() for i, u in enumerate(urls)}
    assert all(r.payload is None if i > 4 else bytes(r.payload) == f"p{i}".encode() for i, r in got.items())
