from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from shelfroll.llm import quality as q

from .helpers import ODD, frame, prose, rows_of, space_words, with_clashes


def brute(text):
    w = space_words(text)
    places: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def test_base_counts_equal_brute_force():
    rng = random.Random(5)
    texts = [r[1] for r in ODD] + ["a b c d e f g h " * 3, "l1 x\nl1 x\n\n \nl1 x", "##é%% |"]
    texts += ["".join(rng.choice("ab \n#é\t") for _ in range(rng.randrange(120))) for _ in range(200)]
    got = q.base_counts([t.encode() if t is not None else None for t in texts])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [*zip(*(got[n].tolist() for n in names), strict=True)] == [brute(t) for t in texts]


def reference_model(texts):
    """Interpolated modified Kneser-Ney by dictionaries, with the module's discounts."""
    table = q.symbol_table()
    grams = Counter()
    for t in texts:
        out = [0] * (q.ORDER - 1)
        for b in t:
            if table[b] or out[-1]:
                out.append(int(table[b]))
        for i in range(q.ORDER - 1, len(out)):
            grams[tuple(out[i - q.ORDER + 1 : i + 1])] += 1
    counts = [grams]
    for _ in range(q.ORDER - 1):
        lower = Counter()
        for g in counts[-1]:
            lower[g[1:]] += 1
        counts.append(lower)

    def p(g):
        if not g:
            return 1 / (1 << q.BITS)
        c = counts[q.ORDER - len(g)]
        d = q._discounts(np.array([*c.values()]))
        own = {k: v for k, v in c.items() if k[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total = sum(own.values())
        spare = sum(d[min(v, 3)] for v in own.values()) / total
        n = own.get(g, 0)
        return (n - d[min(n, 3)] if n else 0) / total + spare * p(g[1:])

    return grams, p


def test_kneser_ney_equals_dictionaries_and_sums_to_one():
    texts = [b"the cat sat on the mat the cat", b"a dog sat on a log 12", b"zz top. zz, top", "né è".encode()]
    key, count = np.unique(q.ngrams(texts)[0], return_counts=True)
    model = q.fit(pd.DataFrame({"key": key.astype(np.int64), "n": count}))
    grams, p = reference_model(texts)
    probe = q.ngrams([b"the dog sat zebra", *texts])[0]
    got = np.exp(q.log_probability(model, probe))
    want = [p(tuple(int(k) >> (q.BITS * i) & 63 for i in range(q.ORDER - 1, -1, -1))) for k in probe]
    assert np.allclose(got, want, rtol=2e-4)
    context = int(probe[5]) >> q.BITS << q.BITS
    total = np.exp(q.log_probability(model, np.arange(context, context + 64, dtype=np.uint32))).sum()
    assert total == pytest.approx(1.0, abs=1e-3)
    assert grams


def test_bands_reject_noise_and_keep_prose(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, 120), "en", "s", 0) for i in range(300)]
    noise = "".join(rng.choice("qxzjkv#%&QXZ[]{}~^") + (" " if rng.random() < 0.2 else "") for _ in range(900))
    rows += [(1000, noise, "en", "s", 0), (1001, "short text", "en", "s", 0), (1002, "one two three four five six seven eight " * 10, "en", "s", 0)]
    docs = frame(spark, rows + ODD)
    out = rows_of(q.op6(with_clashes(docs)))
    assert all(out[i]["kept"] for i in range(300))
    assert not out[1000]["base_failed"] and not out[1000]["kept"]
    assert out[1001]["base_failed"] and out[1002]["base_failed"] and not out[1002]["kept"]
    for d, t, *_ in rows + ODD:
        assert tuple(out[d][n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(t)
    kept = q.accepted(with_clashes(docs))
    assert kept.columns == with_clashes(docs).columns and {r.doc_id for r in kept.collect()} == {d for d, r in out.items() if r["kept"]}
    assert q.op6(docs).count() == docs.count() and q.op6(docs.limit(0)).count() == 0 == q.accepted(docs.limit(0)).count()


def test_bands_depend_on_the_language(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 100), "en", "s", 0) for i in range(100)]
    rows += [(200 + i, " ".join(rng.choice(("ñandú", "años", "señor", "mañana")) + str(rng.randrange(9)) for _ in range(100)), "es", "s", 0) for i in range(100)]
    model = q.fit(q.count_ngrams(frame(spark, rows)))
    bands = q.fit_bands(frame(spark, rows), model)
    assert set(bands) == {"en", "es"} and bands["en"]["median"] != bands["es"]["median"]


def test_copies_do_not_close_the_bands(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.randrange(90, 160)), "en", "s", 0) for i in range(120)]
    copy = prose(rng, 120)
    rows += [(1000 + i, copy, "en", "s", 0) for i in range(180)]
    rows += [(2000, prose(rng, 100), "la", "s", 0), (2001, " ".join(rng.choice(("arma", "virumque", "cano")) + str(rng.randrange(99)) for _ in range(100)), "la", "s", 0)]
    noise = "".join(rng.choice("qxzjkv#%&QXZ[]{}~^") + (" " if rng.random() < 0.2 else "") for _ in range(900))
    out = rows_of(q.op6(frame(spark, [*rows, (3000, noise, "en", "s", 0)])))
    assert [d for d, *_ in rows if not out[d]["kept"]] == []
    assert not out[3000]["kept"]


def test_copies_count_once_in_the_model(spark):
    rng = random.Random(14)
    rows = [(i, prose(rng, 40), "en", "s", 0) for i in range(30)]
    once = q.count_ngrams(frame(spark, rows)).sort_values("key").to_numpy()
    again = q.count_ngrams(frame(spark, rows + rows[:1] * 60 + rows[3:5] * 6).repartition(5)).sort_values("key").to_numpy()
    assert (once == again).all()


def test_long_texts_of_other_topics_stay(spark):
    rng = random.Random(15)
    common = [f"w{rng.randrange(10_000)}" for _ in range(300)]

    def text(n):  # each text has its own share of words of its topic
        topic, share = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)], rng.uniform(0.1, 0.5)
        return " ".join(rng.choice(topic if rng.random() < share else common) for _ in range(n))

    rows = [(i, text(rng.choice((40, 80, 160, 320))), "en", "s", 0) for i in range(200)]
    rows += [(1000 + i, text(6000), "en", "s", 0) for i in range(12)]
    out = rows_of(q.op6(frame(spark, rows)))
    assert [d for d, *_ in rows if not (out[d]["kept"] or out[d]["base_failed"])] == []


def test_deviations_of_both_kinds_are_found():
    rng = np.random.default_rng(16)
    size = np.repeat([6, 8, 10, 12], 4000)
    for between, symbol in ((0.1, 1.5), (0.0, 1.5), (0.1, 0.0)):
        away = np.abs(rng.normal(0, np.sqrt(between**2 + symbol**2 / 2.0 ** (size + 0.5))))
        got = q._deviations(away, size, np.ones(len(size), int))
        for n in (64, 1024, 1 << 20):
            assert np.hypot(got[0], got[1] / n**0.5) == pytest.approx(np.hypot(between, symbol / n**0.5), rel=0.15, abs=0.02), (between, symbol, got)
