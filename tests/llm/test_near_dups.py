from __future__ import annotations

import random

import pytest

from shelfroll.llm import near_dups as nd

from .helpers import ODD, frame, lower_az, prose, rows_of, space_words, with_clashes


def sets_of(docs, width):
    out = []
    for doc_id, text, *_ in docs:
        w = space_words(lower_az(text))
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute(docs, width, percent=80):
    """(set size, component id) of each row: exact links of all pairs, then a union-find."""
    sets = sets_of(docs, width)
    root = [*range(len(docs))]

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int | None] = {}
    for i, d in enumerate(docs):
        known = [x for x in (least.get(find(i)), d[0]) if x is not None]
        least[find(i)] = min(known) if known else None
    return [(d[0], len(sets[i]), least[find(i)]) for i, d in enumerate(docs)]


def copies(rng, n, edits, words=160):
    base = prose(rng, words, 3000).split()
    out = []
    for _ in range(n):
        w = base.copy()
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 120), 3000) for _ in range(60)]
    texts += copies(rng, 60, 8) + copies(rng, 25, 4, 60) + [prose(rng, 80, 3000)] * 20 + ["A b C d E", "a b c d e", "a b c", "a b c d"]
    rng.shuffle(texts)
    # a chain: each links to the next, the ends don't
    chain = prose(rng, 200, 3000).split()
    for k in range(6):
        texts.append(" ".join(chain[k * 10 : k * 10 + 130]))
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "width"), [(1, 4), (2, 4), (3, 5)])
def test_components_equal_all_pairs(spark, seed, width):
    docs = corpus(seed) + ODD
    found = nd.near_duplicates(with_clashes(frame(spark, docs)), width=width)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)
    assert got == sorted(brute(docs, width), key=repr)


@pytest.mark.parametrize("stalled", [10**9, 0])
def test_blocks_of_a_large_bucket(spark, monkeypatch, stalled):
    """Small blocks, after linear rounds that go on to the end (0) or stop at once."""
    monkeypatch.setattr(nd, "PART", 3)
    monkeypatch.setattr(nd, "BLOCK", 6)
    monkeypatch.setattr(nd, "STALLED", stalled)
    monkeypatch.setattr(nd, "BROADCAST_ROWS", 10 if stalled else 10**6)  # texts shuffled to the nodes, or not
    docs = corpus(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame(spark, docs), width=4).collect())
    assert got == sorted(brute(docs, 4))


def hot_bucket(rng, n, words=120):
    """Variants of one text with more and more words changed: they share buckets and fall into several components."""
    base = prose(rng, words, 3000).split()
    out = []
    for i in range(n):
        w = base.copy()
        for k in rng.sample(range(words), 2 + i % 12):
            w[k] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return [(i, t, "en", "s", 0) for i, t in enumerate(out)]


def test_a_hot_bucket_of_several_components(spark, monkeypatch):
    docs = hot_bucket(random.Random(6), 260)
    want = sorted(brute(docs, 4))
    assert 20 < len({c for _, _, c in want}) < 250
    for part in (512, 16):
        monkeypatch.setattr(nd, "PART", part)
        monkeypatch.setattr(nd, "BLOCK", 8 * part)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame(spark, docs), width=4).collect())
        assert got == want


def test_block_search_rows_grow_in_proportion(spark, monkeypatch):
    """Rows sent to blocks: one for a member of the largest component, two for the others, whatever the components."""
    sig = bytes(2 * nd.HASHES)
    bucket = int(nd.band_keys(nd.np.zeros((1, nd.HASHES), nd.np.uint16))[0, 0])
    sent = []
    frame_type = type(spark.range(1))
    real = frame_type.repartition
    monkeypatch.setattr(frame_type, "repartition", lambda self, *a: sent.append(self.count()) or real(self, *a))
    for m in (500, 1000, 2000):
        rows = [(bucket, i, 0 if i < m // 2 else i, 0, m // 2, m - m // 2, 10, sig) for i in range(m)]
        members = spark.createDataFrame(rows, "bucket long, id long, comp long, top long, l long, o long, n long, sig binary")
        nd._block_pairs(members, nd.HASHES + 1, 80)
        assert sent.pop() == m // 2 + 2 * (m - m // 2)


def test_scratch_tables_go(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = {n for n in os.listdir(base) if n.startswith("llm-")}
    out = nd.near_duplicates(frame(spark, corpus(7)), width=4)
    left = {n for n in os.listdir(base) if n.startswith("llm-")} - before
    assert len(left) == 1 and out.count() == len(corpus(7))


def test_query_and_stage(spark):
    docs = corpus(5) + ODD
    want = {d: c for d, _, c in brute(docs, 4) if d is not None}
    out = rows_of(nd.op9(frame(spark, docs).where("doc_id IS NOT NULL")))
    assert {d: r["component_id"] for d, r in out.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in out.items())
    stay = nd.deduplicated(with_clashes(frame(spark, docs)), width=4)
    assert stay.columns == with_clashes(frame(spark, docs)).columns
    ids = sorted((r.doc_id for r in stay.collect()), key=repr)
    # one row of each component; rows without words all stay; the null id has no copy here and stays
    assert ids == sorted({d for d, c in want.items() if d == c} | {None}, key=repr)


def test_empty_table(spark):
    assert nd.op9(frame(spark, [])).count() == 0 == nd.deduplicated(frame(spark, [])).count()


def test_star_contraction(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.id: r.comp for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near: dict[int, set[int]] = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for x in near:
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got[x] == min(seen)
    assert set(got) == set(near)
