from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from shelfroll.llm import toxicity as tx

from .helpers import ODD, crc_mod, frame, rows_of, with_clashes

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["blockhead", "numskull", "dimwit", "halfling"]
SYLLABLES = "ta re mi so lo ven dar pel ur ni gos fra".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.choice([1, 2, 3])))


def text(rng, n, insult=None):
    words = [word(rng) for _ in range(n)]
    if insult:
        words.insert(rng.randrange(n), insult)
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)


def corpus(seed=2, n=400):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        docs.append((i, text(rng, rng.choice([8, 40, 120]), rng.choice(INSULTS) if bad else None), "en", "s", 0))
        labels.append((i, 0, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def machine(spark):
    docs, labels = corpus()
    from shelfroll.llm.common import id_and_text

    return tx.trained(id_and_text(frame(spark, docs)), tx.labelled(spark.createDataFrame(labels, LABELS), tx.crc_mod("doc_id", 5) == 0))


def kernel(a: str, b: str) -> float:
    """The kernel by its definition, over all triples of places."""

    def weights(s):
        out, square = {}, 0.0
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < tx.SPAN and "." not in (s[i], s[j], s[k]):
                w = tx.DECAY ** (k - i - 2)
                out[s[i], s[j], s[k]] = out.get((s[i], s[j], s[k]), 0) + w
                square += w * w
        return out, math.sqrt(square)

    (fa, na), (fb, nb) = weights(a), weights(b)
    return sum(w * fb.get(t, 0) for t, w in fa.items()) / (na * nb)


def test_kernel_equals_its_definition():
    names = ["idiot", "i.d.i.o.t", "idxiot", "banana", "bandana", "tomato", "αβγ", "str.assen"]
    got = tx.Landmarks(names).kernel(names)
    for (i, a), (j, b) in itertools.product(enumerate(names), repeat=2):
        assert got[i, j] == pytest.approx(kernel(a, b), abs=1e-9)
    assert np.linalg.eigvalsh(got).min() > -1e-9
    assert got[0, 1] > 0.5 and got[0, 2] > 0.5 > got[0, 3]


def test_nystroem_features_have_the_kernel_of_the_landmarks():
    names = ["idiot", "moron", "clown", "banana", "tomato"]
    marks = tx.Landmarks(names)
    z = marks.features(names)
    assert z @ z.T == pytest.approx(marks.kernel(names), abs=1e-9)


def test_collapsed_weights_give_the_machine_over_the_features():
    names = ["idiot", "moron", "clown", "banana", "tomato", "potato"]
    marks = tx.Landmarks(names)
    w, bias = tx.fitted(marks.features(names), np.array([1.0, 1, 1, -1, -1, -1]), np.ones(6))
    others = ["idi.ot", "banane", "clowns", "pot"]
    want = marks.features(others) @ w + bias
    got = tx.margins(tx.Units([" ".join(others).replace(".", "-").encode()]), marks.collapsed(w), bias)
    assert got == pytest.approx(want, abs=1e-9)


def test_fitted_machine_is_the_least_of_its_loss():
    rng = np.random.default_rng(4)
    x, y, weight = rng.normal(size=(60, 5)), rng.choice([-1.0, 1.0], 60), rng.random(60)
    w, bias = tx.fitted(x, y, weight, 0.1)

    def loss(w, b):
        return (weight * np.maximum(1 - y * (x @ w + b), 0) ** 2).sum() + 0.1 * (w * w).sum() + 0.001 * b * b

    least = loss(w, bias)
    for _ in range(200):
        assert loss(w + rng.normal(size=5) * 0.01, bias + rng.normal() * 0.01) >= least - 1e-9


def test_units_join_single_letters_and_keep_their_places():
    texts = ["i d i o t, no\ti.d.i.o.t!", "", None, "a b\nÄb ÇA1x -- 日本語"]
    units = tx.Units([t.encode() if t is not None else None for t in texts])
    spans = [(t, texts[t][s - units.offset[t] : e - units.offset[t]]) for t, s, e in zip(units.text, units.start, units.end, strict=True)]
    assert spans == [(0, "i d i o t,"), (0, "no"), (0, "i.d.i.o.t!"), (3, "a b"), (3, "Äb"), (3, "ÇA1x"), (3, "--"), (3, "日本語")]
    names = units.names()
    assert names[:6] == ["i.d.i.o.t", "no", "i.d.i.o.t", "a.b", "ab", "ca.x"] and names[6] == ""


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    got = rows_of(tx.op13(with_clashes(frame(spark, docs)), with_clashes(spark.createDataFrame(labels, LABELS))))
    toxic = {i: x for i, _, x in labels}
    held = [r for r in got.values() if r["held_out"]]
    assert len(held) > 50 and all(r["held_out"] == (crc_mod(i, 5) == 0) for i, r in got.items())
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.97 * len(held)
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if toxic[i] and r["predicted"]:
            assert docs[i][1][r["worst_start"] : r["worst_end"]].strip(".") in INSULTS


@pytest.mark.parametrize("form", ["{}", "{sp}", "{dot}", "{cap}", "{x}", "{dash}"])
def test_gapped_and_inserted_characters(machine, form):
    rng = random.Random(8)
    hits = 0
    for insult in INSULTS:
        half = len(insult) // 2
        forms = {
            "sp": " ".join(insult), "dot": "..".join(insult), "cap": insult.upper(), "x": insult[:half] + "z" + insult[half:],
            "dash": insult[:half] + "-*-" + insult[half:],
        }
        bad = text(rng, 30, form.format(insult, **forms))
        margin, start, end = tx.highest([bad.encode(), text(rng, 30).encode()], machine["table"], machine["bias"])
        scores = 1 / (1 + np.exp(-(machine["slope"] * margin + machine["offset"])))
        hits += scores[0] >= 0.5 > scores[1]
    assert hits == len(INSULTS)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(n=120)
    other = [(i, q, 1 - x if crc_mod(i, 5) == 0 else x) for i, q, x in labels]
    one, two = (rows_of(tx.op13(frame(spark, docs), spark.createDataFrame(rows, LABELS))) for rows in (labels, other))
    assert one == two


def test_odd_rows(spark):
    docs, labels = corpus(n=120)
    docs += ODD + docs[:3]
    labels += [(None, 1, 1), (902, None, None), (5, 1, None), (5, 1, 1), (5, 1, 0), (9999, 0, 1)]
    got = tx.op13(with_clashes(frame(spark, docs).repartition(3)), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs)
    blank = {r["score"] for r in got if r["doc_id"] in (900, 901, 902, 904)}
    assert len(blank) == 1 and all(r["worst_start"] == -1 for r in got if r["doc_id"] in (900, 901, 902))
    assert all(r["held_out"] for r in got if r["doc_id"] is None)


def test_empty_tables_and_missing_classes(spark):
    none = spark.createDataFrame([], LABELS)
    docs, labels = corpus(n=40)
    assert tx.op13(frame(spark, []), none).count() == 0
    assert {r["score"] for r in tx.op13(frame(spark, docs), none).collect()} == {0.0}
    for value in (0, 1):
        one = spark.createDataFrame([(i, 1, value) for i, _, _ in labels], LABELS)
        assert {r["score"] for r in tx.op13(frame(spark, docs), one).collect()} == {float(value)}
    # labels of documents that aren't there: the share of toxic ones among them
    elsewhere = spark.createDataFrame([(i + 5000, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    scores = {r["score"] for r in tx.op13(frame(spark, docs), elsewhere).collect()}
    assert len(scores) == 1 and 0.2 < scores.pop() < 0.3


def test_the_sample_is_bounded(spark):
    docs, labels = corpus()
    from shelfroll.llm.common import id_and_text

    machine = tx.trained(id_and_text(frame(spark, docs)), tx.labelled(spark.createDataFrame(labels, LABELS), tx.F.lit(False)), sample_size=30)
    margin, _, _ = tx.highest([d[1].encode() for d in docs], machine["table"], machine["bias"])
    scores = 1 / (1 + np.exp(-(machine["slope"] * margin + machine["offset"])))
    assert np.mean((scores >= 0.5) == np.array([x for _, _, x in labels])) > 0.9
