from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from shelfroll.llm import decontaminate as d

from .helpers import ODD, alnum_words, frame, prose, rows_of, with_clashes


def brute(docs, items, window=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for doc_id, text, *_ in docs:
        w = alnum_words(text)
        cover, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    cover |= {*range(i, i + n)}
                    found |= windows[k]
        items_text = ",".join(sorted(found))
        out[doc_id] = (len(w), len(cover), len(found), hashlib.sha256(items_text.encode()).hexdigest(), bool(cover))
    return out


def make():
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice((12, 25, 40)), 80)) for i in range(30)] + [(50, "tiny item"), (51, None), (52, "!!"), (53, "tiny item"), (7, "w1 " * 14)]
    docs = []
    for i in range(80):
        text = prose(rng, 150, 80)
        if i % 3 == 0:
            own = items[rng.randrange(30)][1].split()
            cut = rng.randrange(0, max(1, len(own) - 10))
            text = f"{text}. {' '.join(own[cut : cut + rng.choice((9, 10, 14))]).upper()} {prose(rng, 20, 80)}"
        docs.append((i, text, "en", "s", 0))
    docs += [(200, "w1 " * 40, "en", "s", 0), (201, "a TINY-item here", "en", "s", 0), (202, "tiny", "en", "s", 0), *ODD]
    return docs, items


def check(out, want):
    for doc_id, expect in want.items():
        r = out[doc_id]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == expect, doc_id


def test_query_equals_brute_force(spark):
    docs, items = make()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs)
    check(rows_of(d.op8(with_clashes(df), benchmark)), brute(docs, items))
    assert d.op8(df, benchmark).count() == len(docs)
    assert d.op8(df.limit(0), benchmark).count() == 0


def test_empty_benchmark_marks_nothing(spark):
    docs, _ = make()
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert d.op8(frame(spark, docs), benchmark).where("contaminated").count() == 0
    assert d.decontaminated(frame(spark, docs), benchmark).count() == len(docs)


def test_blocks_and_shards_do_not_change_the_result(spark):
    docs, items = make()
    df, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    whole = rows_of(d.contamination(df, benchmark, keep=["doc_id"]))
    parts = rows_of(d.contamination(df, benchmark, keep=["doc_id"], shard_bytes=300, block_bytes=1500))
    assert parts == whole
    kept = {r.doc_id for r in d.decontaminated(with_clashes(df), benchmark, block_bytes=1500).collect()}
    assert kept == {k for k, v in brute(docs, items).items() if not v[4]}


def test_suffix_order_is_lexicographic():
    import numpy as np

    rng = random.Random(4)
    ids = np.array([rng.choice((1, 1, 2, 3, 0)) for _ in range(400)] + [0])
    kept = np.flatnonzero(ids > 0)

    def suffix(i):
        j = i
        while ids[j]:
            j += 1
        return ids[i:j].tolist()[:16]

    assert [suffix(i) for i in d.suffix_order(ids, kept, 16)] == sorted(suffix(i) for i in kept)


def test_suffix_order_is_lexicographic_over_whole_suffixes():
    rng = random.Random(5)
    run = [rng.choice((1, 2)) for _ in range(60)]
    ids = np.array(run + [0] + run + [3, 0] + run[5:] + [0] + [1] * 50 + [0])
    kept = np.flatnonzero(ids > 0)

    def suffix(i):
        j = i
        while ids[j]:
            j += 1
        return ids[i:j].tolist()

    got = [suffix(i) for i in d.suffix_order(ids, kept)]
    assert got == sorted(got) and len(got) == len(kept)


def brute_longest(docs, items, window=10):
    """{(item, word): (length, doc, word)} by trying every pair of places."""
    out = {}
    for item, text in items:
        q = alnum_words(text)
        for i in range(max(0, len(q) - min(window, len(q)) + 1) if q else 0):
            best = None
            for doc_id, t, *_ in docs:
                w = alnum_words(t)
                for p in range(len(w)):
                    k = 0
                    while i + k < len(q) and p + k < len(w) and q[i + k] == w[p + k]:
                        k += 1
                    mine = (-k, doc_id is None, doc_id or 0, p)
                    if k >= min(window, len(q)) and (best is None or mine < best):
                        best = mine
            if best:
                key = (str(item), i)
                out[key] = min(out.get(key, best), best)
    return {k: (-b[0], None if b[1] else b[2], b[3]) for k, b in out.items()}


def test_longest_matches_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice((12, 20)), 30)) for i in range(6)] + [(8, "tiny item"), (9, None), (10, "same same " * 9)]
    docs = [(200, "tiny item and a tiny item", "en", "s", 0), (201, "same " * 30, "en", "s", 0), *ODD[:6]]
    for i in range(25):
        own = items[rng.randrange(6)][1].split()
        lo = rng.randrange(0, 3)
        docs.append((i, f"{prose(rng, 15, 30)} {' '.join(own[lo : lo + rng.randrange(8, 18)])}, {prose(rng, 10, 30)}", "en", "s", 0))
    docs.append((None, items[0][1], "en", "s", 0))
    want = brute_longest(docs, items)
    benchmark = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    df = with_clashes(frame(spark, docs))
    for sizes in ({}, {"shard_bytes": 200, "block_bytes": 150}):
        got = {(r.item_id, r.item_word): (r.n_words, r.doc_id, r.doc_word) for r in d.longest_matches(df, benchmark, **sizes).collect()}
        assert got == want
    # a window occurs where the longest match of the suffix it begins is as long: what the query's columns are made of
    hit = {k for k, v in brute(docs, items).items() if v[4]}
    assert {v[1] for v in want.values()} <= hit
    assert d.longest_matches(df, benchmark.limit(0)).count() == 0 == d.longest_matches(df.limit(0), benchmark).count()


def test_columns_named_like_results(spark):
    docs, items = make()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs).withColumnRenamed("lang", "_spans").withColumnRenamed("source", "_items")
    with pytest.raises(ValueError, match="_spans"):
        d.contamination(df, benchmark)
    got = rows_of(d.contamination(df, benchmark, keep=["doc_id"], block_bytes=1500))
    want = rows_of(d.contamination(frame(spark, docs), benchmark, keep=["doc_id"]))
    assert got == want
