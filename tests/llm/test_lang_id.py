from __future__ import annotations

import random

import numpy as np
import pytest

from shelfroll.llm import lang_id as li

from .helpers import ODD, crc_mod, frame, rows_of, with_clashes

WORDS = {
    "en": "the and that have with this from they which would there their about".split(),
    "de": "der die und nicht werden eine auch sich über können für zwischen".split(),
    "fr": "le la les des une pour dans avec être où même français leçon".split(),
    "es": "el los las una para con está años niño señor también después".split(),
}


def corpus(n=400, langs=WORDS):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lang = [*langs][i % len(langs)]
        rows.append((i, " ".join(rng.choice(langs[lang]) for _ in range(30)), lang, "s", 0))
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 6, 7, 20, 60])
def test_codewords_differ_and_no_bit_is_constant(n):
    code = li.codebook(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    if n > 1:
        assert len({tuple(r) for r in code}) == n
        assert (np.abs(code.sum(axis=0)) < n).all()
        distance = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(distance) >= (1 if n == 2 else 2)


def test_decoding_corrects_a_wrong_bit():
    code = li.codebook(4)
    model = {"code": code, "trust": np.ones(code.shape[1]), "scale": np.ones(code.shape[1])}
    for lang in range(4):
        for bit in range(code.shape[1]):
            m = code[lang] * 4.0
            m[bit] = -m[bit] / 4
            best, score, unsure = li.decode(m[None, :], model)
            assert best[0] == lang and 0 < score[0] <= 1 and not unsure[0]
    _, score, unsure = li.decode(np.zeros((1, code.shape[1])), model)
    assert unsure[0] and score[0] == pytest.approx(0.25)


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus() + ODD
    out = rows_of(li.op1(with_clashes(frame(spark, rows))))
    assert li.op1(frame(spark, rows)).count() == len(rows)
    held = [(d, lang) for d, _, lang, *_ in corpus() if crc_mod(d, 4) == 2]
    assert held and sum(out[d]["lang_pred"] == lang for d, lang in held) / len(held) > 0.99
    for d, t, *_ in rows:
        r = out[d]
        assert r["held_out"] == (crc_mod(d, 4) == 2) and 0 <= r["score"] <= 1
        if t is None or not any(c.isalpha() for c in t):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in {"en", "de", "fr", "es", "ja"}


def test_predictions_use_the_text_alone(spark):
    rows = corpus(200)
    model = li.fit(frame(spark, rows))
    swapped = frame(spark, [(d + 5000, t, None, "other", 0) for d, t, *_ in rows])
    a, b = rows_of(li.predicted(frame(spark, rows), model, ["doc_id"])), rows_of(li.predicted(swapped, model, ["doc_id"]))
    assert all(a[d]["lang_pred"] == b[d + 5000]["lang_pred"] and a[d]["score"] == pytest.approx(b[d + 5000]["score"]) for d in a)


def test_no_labels_one_label_and_no_rows(spark):
    none = frame(spark, [(1, "some text", None, "s", 0), (2, "more", None, "s", 0)])
    assert {r.lang_pred for r in li.op1(none).collect()} == {"und"}
    one = li.fit(frame(spark, [(i, "only english here", "en", "s", 0) for i in range(8)]))
    assert {r.lang_pred for r in li.predicted(none, one).collect()} == {"en"}
    assert li.op1(none.limit(0)).count() == 0


def test_many_languages(spark):
    rng = random.Random(3)
    langs = {f"l{k}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[k : k + 12]) for _ in range(6)) for _ in range(20)] for k in range(9)}
    rows = corpus(360, langs)
    model = li.fit(frame(spark, rows[:270]))
    out = rows_of(li.predicted(frame(spark, rows[270:]), model))
    assert sum(out[d]["lang_pred"] == lang for d, _, lang, *_ in rows[270:]) >= 85
