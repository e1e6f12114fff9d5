from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from shelfroll.llm import quality, secret_scan
from shelfroll.llm.queries import REGISTRY

from .helpers import frame, prose, rows_of, with_clashes
from .test_decontaminate import brute as brute_hits
from .test_near_dups import brute as brute_components


def make():
    rng = random.Random(21)
    odd = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40))  # noqa: E731  so that texts scatter
    rows = [(i, prose(rng, 119, 4000) + (f" {odd()}" if i % 2 else ""), "en", "s", 0) for i in range(150)]
    for i in range(150, 180):  # near copies
        words = rows[i - 150][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", "s", 0))
    items = [(k, prose(rng, 30, 4000)) for k in range(5)]
    rows += [(200 + k, f"{prose(rng, 60, 4000)} {items[k][1]} {prose(rng, 40, 4000)}", "en", "s", 0) for k in range(5)]
    rows += [(300, prose(rng, 400, 4000) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + prose(rng, 40, 4000), "en", "s", 0)]
    rows += [(301, "too short", "en", "s", 0), (302, None, "en", "s", 0), (303, "", None, None, None), (304, "a b c d e f g h " * 20, "en", "s", 0)]
    rows += [rows[0]]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s, _ in rows], items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = make()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    verdict = rows_of(quality.op6(frame(spark, rows)))
    kept = [r for r in rows if verdict[r[0]]["kept"]]
    assert {r[0] for r in rows if r[1] and r[0] < 301} <= {r[0] for r in kept}
    first = {d for d, _, c in brute_components(kept, 5) if d == c}
    left = {r[0]: r for r in kept if r[0] in first}
    hits = brute_hits(left.values(), items)
    left = {d: r for d, r in left.items() if not hits[d][4]}
    out = rows_of(corpus_pipeline.run(spark, str(tmp_path)))
    assert set(out) == set(left) and 300 in out and not {200, 201, 202, 203, 204, 150} & set(out)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for d, r in out.items():
        text = left[d][1]
        for s, _, e in sorted({*secret_scan.base_spans(text), *secret_scan.method_spans(text)}, reverse=True)[:1]:
            text = text[: text.index("token = ")] + "[secret]" + text[e:]
        assert r["ids"] == library.encode(text, add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    rows, items = make()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = with_clashes(frame(spark, rows[:60]))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_registration():
    names = set(entry.queries())
    assert set(REGISTRY) | {"pipeline"} <= names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
