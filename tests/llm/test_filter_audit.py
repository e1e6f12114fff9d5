from __future__ import annotations

import itertools
import random
import re

import duckdb
import pytest

from shelfroll.llm import filter_audit as fa

from .helpers import ODD, frame, prose, rows_of, space_words, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """{(part, order, step): numbers} by running every order over every document."""
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, text, _, source, _ in docs:
        t = text or ""
        words = space_words(t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and least[t] < i:
            fails.add("E")
        parts.setdefault(source or "", []).append((fails, i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), f,
                ]
        for key, numbers in out.items():
            if key[0] == part:
                numbers.append(shapley[numbers[6]])
    return out


def found(df):
    out = {}
    for r in df.collect():
        key = (r["part"], r["filter_order"], r["step"])
        assert key not in out
        out[key] = [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "filter", "shapley")]
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    docs = [(i, t, lang, s, n) for i, t, lang, s, n in ODD]
    hot = prose(rng, 250)
    for i in range(160):
        text = prose(rng, rng.choice([3, 150, 199, 200, 260]), rng.choice([20, 400]))
        if rng.random() < 0.3:
            text = text.title()
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|^~")
        if i % 3 == 0:
            text = hot  # a third of all rows
        docs.append((rng.randrange(10_000) if i % 40 else None, text, "en", rng.choice(["a", "b", "", None]), len(text)))
    ids = [d[0] for d in docs]
    labels = [(rng.choice(ids), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    return docs, labels


def test_every_order_is_met_once_by_adjacent_swaps():
    for n in range(6):
        order, seen = list(range(n)), [tuple(range(n))]
        for level in fa.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_a_swap_keeps_the_counts_of_all_masks():
    rng = random.Random(3)
    masks = {m: (rng.randrange(1, 9), rng.randrange(3), rng.randrange(3)) for m in rng.sample(range(32), 20)}
    diagram = fa.Diagram(masks, 5)
    for level in [*fa.adjacent_swaps(5)]:
        diagram.swap(level)
        for mask in range(32):
            node = diagram.root
            for f in diagram.order:
                node = None if node is None else node[mask >> f & 1]
            assert (node or fa.NONE) == masks.get(mask, fa.NONE)


def test_equal_sub_diagrams_are_one_object():
    masks = {m: (2, 0, 0) for m in range(32)}
    diagram = fa.Diagram(masks, 5)
    assert len(diagram.nodes) == 6  # one node a level and one leaf


def test_audit_equals_brute_force_and_its_sql(spark):
    docs, labels = corpus()
    d, lab = with_clashes(frame(spark, docs)), with_clashes(spark.createDataFrame(labels, LABELS))
    got = found(fa.op11(d, lab))
    assert got == brute(docs, labels)
    con = duckdb.connect()
    con.register("documents", frame(spark, docs).toArrow())
    con.register("labels", spark.createDataFrame(labels, LABELS).toArrow())
    sql = con.execute(fa.OP11_SQL)
    names = [c[0] for c in sql.description]
    rows = {}
    for r in sql.fetchall():
        r = dict(zip(names, r, strict=True))
        rows[r["part"], r["filter_order"], r["step"]] = [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "filter", "shapley")]
    assert rows == got
    assert all(sum(1 for k in got if k[0] == part) == 600 for part in {k[0] for k in got})


def test_shapley_totals_share_out_what_the_filters_remove_together(spark):
    docs, labels = corpus(9)
    for part, rows in itertools.groupby(sorted(found(fa.op11(frame(spark, docs), spark.createDataFrame(labels, LABELS))).items()), key=lambda kv: kv[0][0]):
        rows = list(rows)
        total = {v[6]: v[7] for _, v in rows}
        last = [v for k, v in rows if k[2] == 5][0]
        n = sum(1 for d in docs if (d[3] or "") == part)
        assert sum(total.values()) == 120 * (n - last[0])


def test_empty_tables(spark):
    assert fa.op11(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0
    got = found(fa.op11(frame(spark, [(1, "a", "en", "s", 1)]), spark.createDataFrame([], LABELS)))
    assert len(got) == 600 and got["s", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, "A", 120]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_other_numbers_of_filters(n):
    rows = fa.audit({0: (5, 1, 1)}, "XYZ"[:n])
    assert len(rows) == [0, 1, 4, 18][n]
    assert all(r[3] == 5 and r[4] == 0 for r in rows)
