"""WARC captures and the resolution of not-modified revisits.

``write_warc`` and ``read_warc`` turn capture rows into gzip-per-record WARC files in a shared folder and back. A
``revisit`` record holds a 304 answer and no body; ``resolved`` finds, by canonical URL, the latest full response
captured earlier, compares the validators and merges the headers a 304 may update into the stored ones.

The as-of join is two window steps without a self-join. Rows are grouped by canonical URL and ``BUCKET`` seconds of
capture time: inside a bucket a window carries the last response forward, and one row per bucket carries its last
response to the later buckets. So a URL that holds a third of all captures is spread over its buckets; its second-step
group has one row per bucket (8,760 a year), however many captures there are. Bodies don't take part in either shuffle.

Edge cases: a null URL or date can't be resolved (``missing``); responses at the very time of the revisit are not
earlier; of several responses at one time the largest record id counts, and of several with that id too the one whose
headers, as sorted lines, come first; repeated rows keep their rows; a validator
that only one side has is not compared; with none in common the revisit is ``unverified``; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stored

BUCKET = 3600
#: Headers that a 304 answer may update in the stored response, and the validators.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
VALIDATORS = ("etag", "last-modified")
#: Fixed values of the stand-in captures: two dates of last change.
MODIFIED = ("Wed, 01 Nov 2023 00:00:00 GMT", "Thu, 02 Nov 2023 00:00:00 GMT")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"

CAPTURE = "record_id string, type string, url string, date timestamp, status int, headers map<string,string>, body string"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, trailing slash and tracking parameters (``utm_*``, ``ref``) dropped;
    host in lower case, remaining parameters sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*(/[^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref)(=|$)"))
    listed = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(listed != "", F.concat(F.lit("?"), listed)).otherwise(F.lit("")))


# ---- files --------------------------------------------------------------------------------------------------------


def record_bytes(record_id: str, kind: str, url: str | None, date: str | None, status: int | None, headers: list, body: str | None) -> bytes:
    """One WARC record with its HTTP head and body."""
    head = [f"HTTP/1.1 {status or 0} {'OK' if status == 200 else 'Not Modified' if status == 304 else 'Other'}"]
    head += [f"{k}: {v}" for k, v in headers]
    block = ("\r\n".join(head) + "\r\n\r\n").encode() + (body or "").encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url}")
    if date is not None:
        lines.append(f"WARC-Date: {date}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"Content-Type: application/http; msgtype={'response' if kind in ('response', 'revisit') else kind}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def write_warc(captures: DataFrame, folder: str) -> list[str]:
    """Writes one file per task; returns the paths that finished tasks name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out = None
        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("record_id", "type", "url", "stamp", "status", "headers", "body")]
            for row in zip(*columns, strict=True):
                if out is None:
                    system, inner = fs.FileSystem.from_uri(path)
                    system.create_dir(inner.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(inner)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(pack.compress(record_bytes(*row[:5], row[5] or [], row[6])) + pack.flush())
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path]})

    rows = captures.withColumn("stamp", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return sorted(r.path for r in rows.mapInArrow(run, "path string").collect())


def records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC headers, block) of the records of a stream of gzip members; ``read(n)`` gives the next bytes."""
    unpack, left, plain = zlib.decompressobj(31), b"", bytearray()
    ended = False

    def more() -> bool:
        nonlocal unpack, left, ended
        while not ended:
            data = left or read(1 << 20)
            left = b""
            if not data:
                ended = True
                return False
            plain.extend(unpack.decompress(data))
            if unpack.eof:
                left, unpack = unpack.unused_data, zlib.decompressobj(31)
            return True
        return False

    while True:
        while (at := plain.find(b"\r\n\r\n")) < 0:
            if not more():
                return
        lines = bytes(plain[:at]).decode("utf-8", "replace").split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head.get("content-length", "0"))
        while len(plain) < at + 4 + size + 4:
            if not more():
                break
        yield head, bytes(plain[at + 4 : at + 4 + size])
        del plain[: at + 4 + size + 4]


def read_warc(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Capture rows of WARC files (one task per file, read as a stream)."""
    names = ["record_id", "type", "url", "stamp", "status", "headers", "body"]
    kind = pa.map_(pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), kind, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            for path in b.column("path").to_pylist():
                system, inner = fs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                size = 0
                with system.open_input_stream(inner) as stream:
                    for head, block in records(stream.read):
                        http, _, body = block.partition(b"\r\n\r\n")
                        lines = http.decode("utf-8", "replace").split("\r\n")
                        status = lines[0].split(" ")[1:2]
                        fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
                        rows.append((
                            head.get("warc-record-id", "").strip("<>"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-date"),
                            int(status[0]) if status and status[0].isdigit() else None, [*fields.items()], body.decode("utf-8", "replace"),
                        ))
                        size += len(block)
                        if size > 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    schema = "record_id string, type string, url string, stamp string, status int, headers map<string,string>, body string"
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    files = files.repartition(max(1, len(paths)))
    out = files.mapInArrow(run, schema)
    return out.select("record_id", "type", "url", F.to_timestamp("stamp").alias("date"), "status", "headers", "body")


# ---- resolution ---------------------------------------------------------------------------------------------------


def resolved(captures: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per revisit: record_id, url_key, date, response_id, response_date, verdict and merged headers.

    verdict: ``resolved`` (a validator both sides have agrees and none differs), ``mismatch`` (one differs),
    ``unverified`` (none in common) or ``missing`` (no earlier full response; the headers are the revisit's own).
    """
    from pyspark.sql import Window as W

    rows = captures.where("type IN ('response', 'revisit')").select(
        "record_id", "type", canonical_url(F.col("url")).alias("url_key"), "date", "status", "headers"
    )
    rows = stored(rows, "captures")  # read several times below; the files with their bodies are parsed once
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("url_key").isNotNull() & F.col("date").isNotNull()
    rows = rows.withColumn("slot", F.floor(F.unix_timestamp("date") / bucket))
    rows = rows.withColumn("answer", F.when(full, F.struct("date", "record_id", "headers")))
    # inside a bucket: the last response strictly earlier; a range frame leaves out rows of the same time
    stamp = F.unix_micros("date")
    own = W.partitionBy("url_key", "slot").orderBy(stamp).rangeBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.max(F.when(full, F.struct("date", "record_id"))).over(own))
    # between buckets: the last response of the latest earlier bucket that has one
    last = rows.where("answer IS NOT NULL").groupBy("url_key", "slot").agg(F.max(F.struct("date", "record_id")).alias("last"))
    revisits = rows.where("type = 'revisit'")
    slots = revisits.groupBy("url_key", "slot").agg(F.lit(None).cast("struct<date:timestamp,record_id:string>").alias("last")).union(last)
    slots = slots.groupBy("url_key", "slot").agg(F.max("last").alias("last"))
    before = W.partitionBy("url_key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.select("url_key", "slot", F.last("last", ignorenulls=True).over(before).alias("far"))
    found = revisits.join(slots, ["url_key", "slot"], "left").withColumn("hit", F.coalesce("near", "far"))
    # the headers of the response found, by record id, time and URL
    answers = rows.where("answer IS NOT NULL").groupBy(
        F.col("url_key").alias("a_key"), F.col("date").alias("a_date"), F.col("record_id").alias("a_id")
    ).agg(F.min_by("headers", F.coalesce(header_text(F.col("headers")), F.lit(""))).alias("stored"))
    on = (F.col("url_key") == F.col("a_key")) & (F.col("hit.date") == F.col("a_date")) & (F.col("hit.record_id") == F.col("a_id"))
    both = found.join(answers, on, "left")

    none = F.create_map().cast("map<string,string>")
    new, old = F.coalesce("headers", none), F.coalesce("stored", none)
    pairs = [(F.try_element_at(new, F.lit(v)), F.try_element_at(old, F.lit(v))) for v in VALIDATORS]
    differs = F.lit(False)
    agrees = F.lit(False)
    for a, b in pairs:
        differs = differs | F.coalesce(a != b, F.lit(False))
        agrees = agrees | F.coalesce(a == b, F.lit(False))
    verdict = F.when(F.col("a_id").isNull(), "missing").when(differs, "mismatch").when(agrees, "resolved").otherwise("unverified")
    permitted = F.map_filter(new, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(permitted), k))
    merged = F.when(verdict.isin("resolved", "unverified"), F.map_concat(kept, permitted)).otherwise(new)
    return both.select(
        "record_id", "url_key", "date", F.col("a_id").alias("response_id"), F.col("a_date").alias("response_date"),
        verdict.alias("verdict"), merged.alias("headers"),
    )


def header_text(headers: Column) -> Column:
    """Headers as sorted ``name: value`` lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


# ---- stand-in captures --------------------------------------------------------------------------------------------


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture rows from the page table: every page is a full response and is asked for again once.

    A hash of the page decides how: with or without each validator on either side, some of them differing, some under
    another form of the URL, some before anything was captured. A page without id is known by its URL and text.
    """
    text = F.concat(F.coalesce("url", F.lit("")), F.lit("|"), F.coalesce("html", F.lit("")))
    base = pages.select(
        F.coalesce(F.col("page_id").cast("string"), F.md5(text)).alias("key"), F.coalesce(F.col("page_id"), F.lit(0)).alias("number"), "url", "html",
        F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"')).alias("tag"),
    )
    digit = lambda k: F.expr(f"instr('0123456789abcdef', substr(md5(key), {k}, 1)) - 1")
    at = lambda seconds: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("number") * 61 + seconds)

    def head(*pairs) -> Column:
        """Headers; those without a value are left out."""
        entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    response = base.select(
        F.concat(F.lit("urn:page:"), "key").alias("record_id"), F.lit("response").alias("type"), "url", at(F.lit(0)).alias("date"),
        F.lit(200).alias("status"),
        head(
            ("content-type", F.lit("text/html")), ("etag", F.when(digit(1) % 4 != 3, F.col("tag"))),
            ("last-modified", F.when(digit(2) % 4 != 3, F.lit(MODIFIED[0]))), ("server", F.lit("a")),
        ).alias("headers"), F.col("html").alias("body"),
    )
    late = F.when(digit(7) % 11 == 0, -30).otherwise(86_400 + (digit(7) % 7) * 3600)
    revisit = base.select(
        F.concat(F.lit("urn:again:"), "key").alias("record_id"), F.lit("revisit").alias("type"),
        F.when(digit(3) % 4 == 1, F.concat("url", F.lit("#again"))).otherwise(F.col("url")).alias("url"), at(late).alias("date"),
        F.lit(304).alias("status"),
        head(
            ("cache-control", F.lit("max-age=60")),
            ("etag", F.when(digit(4) % 4 < 2, F.when(digit(5) % 5 == 0, F.lit('"other"')).otherwise(F.col("tag")))),
            ("last-modified", F.when(digit(4) % 2 == 0, F.when(digit(6) % 5 == 0, F.lit(MODIFIED[1])).otherwise(F.lit(MODIFIED[0])))),
            ("server", F.lit("b")),
        ).alias("headers"), F.lit(None).cast("string").alias("body"),
    )
    return response.union(revisit)


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The revisits of the stand-in captures, written to WARC files, read back and resolved."""
    paths = write_warc(captures_of_pages(pages), scratch(spark, "warc"))
    out = resolved(read_warc(spark, paths)) if paths else resolved(spark.createDataFrame([], CAPTURE))
    return out.select(
        "record_id", "url_key", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "response_id", "verdict",
        F.sha2(header_text(F.col("headers")).cast("binary"), 256).alias("headers_sha256"),
    )


OP5_SQL = rf"""
WITH b AS (SELECT *, md5(key) AS h, 1700000000 + number * 61 AS s0 FROM (
  SELECT coalesce(CAST(page_id AS VARCHAR), md5(coalesce(url, '') || '|' || coalesce(html, ''))) AS key, coalesce(page_id, 0) AS number, url,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag FROM pages)),
g AS (SELECT *, {", ".join(f"instr('0123456789abcdef', substr(h, {k}, 1)) - 1 AS h{k}" for k in range(1, 8))} FROM b),
c AS (
  SELECT 'urn:page:' || key AS record_id, 'response' AS type, url, s0 AS s, CASE WHEN h1 % 4 <> 3 THEN tag END AS etag,
         CASE WHEN h2 % 4 <> 3 THEN '{MODIFIED[0]}' END AS modified FROM g
  UNION ALL
  SELECT 'urn:again:' || key, 'revisit', CASE WHEN h3 % 4 = 1 THEN url || '#again' ELSE url END,
         s0 + CASE WHEN h7 % 11 = 0 THEN -30 ELSE 86400 + (h7 % 7) * 3600 END,
         CASE WHEN h4 % 4 < 2 THEN CASE WHEN h5 % 5 = 0 THEN '"other"' ELSE tag END END,
         CASE WHEN h4 % 2 = 0 THEN CASE WHEN h6 % 5 = 0 THEN '{MODIFIED[1]}' ELSE '{MODIFIED[0]}' END END FROM g),
p AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS r FROM c),
q AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(r, '^[^/?]*', 0)), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
             regexp_replace(regexp_extract(r, '^[^/?]*(/[^?]*)', 1), '/+$', '') AS path,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(r, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)'))), '&') AS args FROM p),
k AS (SELECT record_id, type, s, etag, modified, host || path || CASE WHEN args <> '' THEN '?' || args ELSE '' END AS url_key FROM q),
a AS (SELECT * FROM k WHERE type = 'response'),
j AS (SELECT v.*, a.record_id AS response_id, a.etag AS old_etag, a.modified AS old_modified,
             row_number() OVER (PARTITION BY v.record_id ORDER BY a.s DESC, a.record_id DESC) AS n
      FROM k AS v LEFT JOIN a ON a.url_key = v.url_key AND a.s < v.s WHERE v.type = 'revisit'),
f AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN etag <> old_etag OR modified <> old_modified THEN 'mismatch'
                     WHEN etag = old_etag OR modified = old_modified THEN 'resolved' ELSE 'unverified' END AS verdict FROM j WHERE n = 1),
m AS (SELECT *, verdict IN ('resolved', 'unverified') AS merged FROM f)
SELECT record_id, url_key, strftime(make_timestamp(CAST(s * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS date, response_id, verdict,
       sha256(concat_ws(chr(10), 'cache-control: max-age=60', CASE WHEN merged THEN 'content-type: text/html' END,
                        'etag: ' || CASE WHEN merged THEN coalesce(etag, old_etag) ELSE etag END,
                        'last-modified: ' || CASE WHEN merged THEN coalesce(modified, old_modified) ELSE modified END,
                        CASE WHEN merged THEN 'server: a' ELSE 'server: b' END)) AS headers_sha256
FROM m
"""
