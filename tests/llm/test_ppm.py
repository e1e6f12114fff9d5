from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfroll.llm import ppm

from .helpers import ODD, crc_mod, frame, lower_az, prose, rows_of, space_words, with_clashes


class Reference:
    """PPM-C with exclusion by dictionaries, trained on the streams of documents."""

    def __init__(self, train: list[list[bytes]]):
        self.counts: dict[bytes, Counter] = defaultdict(Counter)
        for words in train:
            for context, symbol in self.stream(words):
                self.learn(context, symbol, 1)

    @staticmethod
    def stream(words):
        b = b" " + b"".join(w + b" " for w in words)
        return [(b[max(0, i - ppm.ORDER) : i], b[i] if i < len(b) else ppm.END) for i in range(1, len(b) + 1)]

    def learn(self, context, symbol, n):
        for k in range(len(context) + 1):
            self.counts[context[len(context) - k :]][symbol] += n

    def log10(self, context, symbol):
        excluded: set[int] = set()
        out = 0.0
        while True:
            if context in self.counts:
                left = {s: n for s, n in self.counts[context].items() if s not in excluded}
                total = sum(left.values()) + len(left)
                if symbol in left:
                    return out + math.log10(left[symbol] / total)
                if left:
                    out += math.log10(len(left) / total)
                excluded |= set(self.counts[context])
            if not context:
                return out - math.log10(ppm.SYMBOLS - len(excluded))
            context = context[1:]

    def text(self, words):
        return sum(self.log10(c, s) for c, s in self.stream(words))


def brute(rows):
    words_of = lambda t: [w.encode() for w in space_words(lower_az(t))]
    learned = [words_of(t) for d, t, *_ in rows if crc_mod(d, 10)]
    train = Counter(w for words in learned for w in words)
    ends = len(learned)
    model = Reference(learned)
    n, v = sum(train.values()) + ends, len(train) + (ends > 0)
    out = {}
    for d, t, *_ in rows:
        words = words_of(t)
        counts = [train[w] for w in words] + [ends]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in counts)
        out[d] = (crc_mod(d, 10) == 0, len(counts), sum(c > 0 for c in counts), n, base, model.text(words))
    return out


def corpus():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 11))) for _ in range(150)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))).replace("a", rng.choice("aA")), "en", "s", 0) for i in range(80)] + ODD


def check(out, want):
    for d, (held, tokens, known, n, base, score) in want.items():
        r = out[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, n), d
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] == pytest.approx(score, abs=1e-6)


def test_scores_equal_the_reference(spark):
    rows = corpus()
    check(rows_of(ppm.op10(with_clashes(frame(spark, rows)))), brute(rows))
    assert ppm.op10(frame(spark, rows)).count() == len(rows)


def test_blocks_do_not_change_the_scores(spark, monkeypatch):
    from shelfroll.llm.common import crc_mod as held

    # small parts: hot pairs of bytes are split by the third, and parts are summed in several groups
    monkeypatch.setattr(ppm, "PART_ROWS", 50)
    monkeypatch.setattr(ppm, "GROUP_ROWS", 120)
    rows = corpus()
    small = ppm.scores(frame(spark, rows).repartition(3), held("doc_id", 10) == 0, block_bytes=500)
    check(rows_of(small), brute(rows))


def test_probabilities_sum_to_one():
    model = Reference([[b"abc", b"x"], [b"abc", b"abd"], [b"abc"], [b"x"], []])
    assert sum(10 ** model.log10(b" ab", s) for s in range(ppm.SYMBOLS)) == pytest.approx(1.0)


def test_no_training_text_and_no_rows(spark):
    held = [i for i in range(200) if crc_mod(i, 10) == 0][:3]
    rows = [(i, "some words", "en", "s", 0) for i in held]
    check(rows_of(ppm.op10(frame(spark, rows))), brute(rows))
    assert ppm.op10(frame(spark, [])).count() == 0


def test_seen_kind_of_text_scores_better_than_noise(spark):
    """Among held-out documents: one that was learned from is known by heart, noise or not."""
    rng = random.Random(4)
    noise = next(i for i in range(1000, 2000) if crc_mod(i, 10) == 0)
    rows = [(i, prose(rng, 80, 300), "en", "s", 0) for i in range(100)]
    rows += [(noise, " ".join("".join(rng.choice("#qzxv") for _ in range(3)) for _ in range(80)), "en", "s", 0)]
    out = rows_of(ppm.op10(frame(spark, rows)))
    per = {d: r["score"] / r["n_tokens"] for d, r in out.items() if r["held_out"]}
    assert len(per) > 5 and per[noise] < min(p for d, p in per.items() if d != noise)


def test_the_order_of_words_changes_the_score(spark):
    rng = random.Random(6)
    sentences = [prose(rng, 12, 300) for _ in range(8)]
    rows = [(i, " ".join(rng.choice(sentences) for _ in range(12)), "en", "s", 0) for i in range(120)]
    salad = sentences[0].split()
    rng.shuffle(salad)
    rows += [(10_000, sentences[0], "en", "s", 0), (10_001, " ".join(salad), "en", "s", 0)]
    out = rows_of(ppm.op10(frame(spark, rows)))
    one, two = out[10_000], out[10_001]
    assert one["base_score"] == pytest.approx(two["base_score"]) and one["score"] > two["score"] + 3


def test_table_and_sums():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 60, 5000))
    rng.shuffle(keys)
    table = ppm.Table(keys, np.arange(len(keys)) / 7)
    wanted = rng.integers(0, len(keys), 20_000)
    assert (table.of(keys[wanted]) == wanted / 7).all()
    assert len(ppm.Table(keys[:0], np.zeros(0)).of(keys[:0])) == 0
    held = ppm.Sums()
    pieces = [(rng.integers(0, 50, 30), rng.integers(0, 9, 30)) for _ in range(20)]
    for piece in pieces:
        held.add(*piece)
    want = Counter()
    for k, c in pieces:
        for x, y in zip(k.tolist(), c.tolist(), strict=True):
            want[x] += y
    got = dict(zip(*(x.tolist() for x in held.merge()), strict=True))
    assert got == {k: want[k] for k in sorted({x for p, _ in pieces for x in p.tolist()})}


def test_hot_pairs_are_split():
    deal = ppm.Deal({5: 1000, 6: 40, 7: 30, 8: 50, -33: 9}, 120, 60)
    assert deal.hot == [5] and deal.low == 3 and deal.words == deal.low + 17 and len(deal.load) == deal.words + 2
    keys = np.array([(6 << ppm._ORDER_SHIFT) | (third << 16 | 5) << ppm._SYMBOL_BITS | 1 for third in range(256)])
    assert len(set(deal.windows(keys).tolist())) > 10 and deal.windows(keys).min() >= deal.low


def test_a_long_text_and_long_word(spark):
    rng = random.Random(12)
    rows = corpus() + [(5000, prose(rng, 30_000, 200), "en", "s", 0), (5001, "ab" * 40_000, "en", "s", 0)]
    out = rows_of(ppm.op10(frame(spark, rows)))
    want = brute(rows)
    for d in (5000, 5001, 0, 7):
        assert out[d]["score"] == pytest.approx(want[d][5], rel=1e-9)


def test_a_merge_holds_its_arrays_about_twice():
    """A block's windows are most of a task's memory: merging them takes no more than the sorted copy and its order."""
    n = 900_000
    rng = np.random.default_rng(1)
    sums, plain = ppm.Sums(), Counter()
    tracemalloc.start()
    try:
        for _ in range(6):
            keys = np.unique(rng.integers(0, 10**12, n // 6))
            plain.update(keys[:50].tolist())
            sums.add(keys, np.ones(len(keys), np.int64))
        del keys
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        keys, counts = sums.merge()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak - before < 26 * n
    assert (np.diff(keys) > 0).all() and counts.sum() >= n - 1000
    found = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert all(found[k] >= c for k, c in plain.items())
    empty = ppm.Sums()
    empty.add(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert [len(x) for x in empty.merge()] == [0, 0]


def test_a_merge_into_many_keys_counts_in_place():
    """Keys a block has already are most of what comes: counting them takes little beside what is held."""
    n = 2_000_000
    sums = ppm.Sums()
    sums.add(np.arange(n) * 3, np.ones(n, np.int64))
    sums.merge()
    more = np.arange(0, 300_000) * 6  # all known
    tracemalloc.start()
    try:
        for _ in range(2):
            sums.add(more, np.ones(len(more), np.int64))
        sums.add(np.array([1, 4]), np.array([5, 6]))
        keys, counts = sums.merge()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 28 * n  # the old arrays and the new ones: before, all keys were sorted again
    assert len(keys) == n + 2 and (np.diff(keys) > 0).all() and counts.sum() == n + 600_000 + 11
    assert dict(zip(keys[:6].tolist(), counts[:6].tolist(), strict=True)) == {0: 3, 1: 5, 3: 1, 4: 6, 6: 3, 9: 1}


def test_keys_are_dealt_in_slices():
    """The order of a block's keys by part takes a few bytes a key, and is that of the parts."""
    n = 3 * ppm.SLICE_KEYS + 5
    rng = np.random.default_rng(2)
    keys = np.sort(6 << ppm._ORDER_SHIFT | rng.integers(0, 1 << ppm._ORDER_SHIFT, n))
    deal = ppm.Deal({p: 100 for p in range(1 << 16)}, 10, 10_000)
    tracemalloc.start()
    try:
        order, parts, cuts = deal.cut(ppm.WINDOWS, keys)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 * n
    part = deal.windows(keys)
    assert parts == np.unique(part).tolist() and cuts[0] == 0 and cuts[-1] == n
    for p, lo, hi in list(zip(parts, cuts[:-1], cuts[1:], strict=True))[:20]:
        assert (order[lo:hi] == np.flatnonzero(part == p)).all()


def test_a_table_keeps_keys_and_values_where_they_are():
    """A slot is the place of its key: beside the arrays it came in, a table takes at most 12 bytes a key."""
    n = 1 << 20
    keys = np.random.default_rng(7).permutation(np.arange(n) * 1_000_003)
    values = np.arange(n) / 3
    tracemalloc.start()
    try:
        table = ppm.Table(keys, values)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 12 * n
    wanted = np.random.default_rng(8).integers(0, n, 100_000)
    assert (table.of(keys[wanted]) == values[wanted]).all() and (table.of(keys[-1:]) == values[-1:]).all()


def test_sums_and_values_are_one_pass(spark):
    """A task with two passes keeps two Python workers: the groups of a part are summed where its values are looked up."""
    deal = ppm.Deal({5: 10}, 10, 100)
    packed = lambda keys, n: (bytearray(ppm._pack_sorted(np.array(keys))), bytearray(ppm._pack(np.array(n))))
    rows = [(deal.words, 0, 0, *packed([3, 8], [1, 0])), (deal.words, 1, 0, *packed([3, 9], [4, 2]))]
    out = ppm._values(spark.createDataFrame(rows, ppm.PIECE_SCHEMA), deal, np.zeros((0, 2), np.int64))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    (row,) = out.collect()
    assert ppm._unpack_sorted(bytes(row["keys"])).tolist() == [3, 8, 9] and ppm._unpack_values(bytes(row["values"])).tolist() == [5, 0, 2]
    assert (row["n"], row["v"]) == (7, 2)


def test_drained_sums_hold_nothing():
    sums = ppm.Sums()
    sums.add(np.array([1, 2]), np.array([3, 4]))
    assert [x.tolist() for x in sums.drain()] == [[1, 2], [3, 4]] and [len(x) for x in sums.merge()] == [0, 0]
