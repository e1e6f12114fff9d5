"""License scan with a positional rare-token index, in DataFrame functions only.

Each template is a list of notice words with a mandatory key phrase. A first pass counts in how many documents each
template word occurs; its inverse document frequency picks every template's ``ANCHORS`` rarest words, always with the
rarest word of the key phrase. The index maps these words to (template, position). In a document the anchor words are
looked up, a posting at word ``i`` with position ``p`` proposes the template at ``i - p``, equal proposals are united, and
the key phrase is verified word by word at its place. As every key phrase holds one of its template's anchors, no
occurrence is missed. ``score`` is the idf-weighted share of template words at their places, the best over all labels.

Documents without an anchor word are told apart by one regular expression and only counted. There is no shuffle of
texts; the word counts (one row per template word) are all that leaves a task.

Edge cases: null and empty texts have no words, empty labels, null places and score 0; other columns are ignored;
repeated ids keep their rows; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHORS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what separates words (everything in ASCII but digits and letters).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Label, words of the notice, mandatory key phrase. The first three are the base phrases.
TEMPLATES = [
    ("cc-by", "licensed under cc by", "cc by"),
    ("gpl", "under the terms of the gnu general public license", "general public license"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("public-domain", "released into the public domain", "into the public domain"),
    ("spdx", "spdx license identifier", "spdx license identifier"),
]
BASE = 3


def vocabulary() -> list[str]:
    return sorted({w for _, words, _ in TEMPLATES for w in words.split()})


def _strings(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def key_offset(words: list[str], key: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """(number of documents, documents per template word); one row per template word comes to the driver."""
    known = F.expr(_strings(vocabulary()))
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), SEPARATORS)
    found = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words, known))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.get("", 0), counts  # the empty word once for each document


def idf(counts: tuple[int, dict[str, int]]) -> dict[str, float]:
    n, df = counts
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-6 for w in vocabulary()}


def index(weight: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Anchor word -> postings (template, position)."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, words, key) in enumerate(TEMPLATES):
        words, key = words.split(), key.split()
        chosen = {max(key, key=lambda w: (weight[w], w))}
        chosen |= set(sorted(set(words), key=lambda w: (-weight[w], w))[: ANCHORS - 1])
        for p, w in enumerate(words):
            if w in chosen:
                postings.setdefault(w, []).append((t, p))
    return postings


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (text) with ``n_words`` and ``found``: verified (template, phrase start, share)."""
    weight = idf(document_frequencies(docs))
    postings = index(weight)
    anchor = "|".join(sorted(postings))
    text = F.coalesce("text", F.lit(""))
    # a word of its own, in either case; non-ASCII letters belong to words
    has_anchor = text.rlike(rf"(?i)(?<![0-9a-z\u0080-\x{{10FFFF}}])(?:{anchor})(?![0-9a-z\u0080-\x{{10FFFF}}])")
    raw = F.split(text, SEPARATORS)
    n_words: Column = F.size(raw) - F.when(F.get(raw, F.lit(0)) == "", 1).otherwise(0) - F.when(
        (F.size(raw) > 1) & (F.element_at(raw, -1) == ""), 1
    ).otherwise(0)
    words = F.when(has_anchor, F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != ""))
    out = docs.select(*keep, n_words.cast("long").alias("n_words"), words.alias("w"))

    cases = " ".join(
        f"WHEN '{w}' THEN array(" + ", ".join(f"struct({t} AS t, i - {p} AS s)" for t, p in own) + ")" for w, own in sorted(postings.items())
    )
    none = "cast(array() AS array<struct<t:int,s:int>>)"
    proposals = f"array_distinct(flatten(transform(w, (x, i) -> CASE x {cases} ELSE {none} END)))"
    verified, shares, offsets = [], [], []
    for t, (_, notice, key) in enumerate(TEMPLATES):
        notice, key = notice.split(), key.split()
        at = key_offset(notice, key)
        same = " AND ".join(f"get(w, h.s + {at + k}) = '{x}'" for k, x in enumerate(key))
        verified.append(f"WHEN {t} THEN ({same})")
        total = sum(weight[x] for x in notice)
        part = " + ".join(f"IF(get(w, h.s + {k}) <=> '{x}', {weight[x] / total!r}D, 0D)" for k, x in enumerate(notice))
        shares.append(f"WHEN {t} THEN {part}")
        offsets.append(f"WHEN {t} THEN {at}")
    out = out.withColumn("found", F.expr(f"filter({proposals}, h -> coalesce(CASE h.t {' '.join(verified)} END, false))"))
    out = out.withColumn(
        "found",
        F.expr(
            f"transform(found, h -> struct(h.t AS t, h.s + CASE h.t {' '.join(offsets)} END AS start, CASE h.t {' '.join(shares)} END AS share))"
        ),
    )
    return out.drop("w")


def op7(docs: DataFrame) -> DataFrame:
    """Columns of the contract, one row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scanned(rows, ["doc_id"])
    names = " ".join(f"WHEN {t} THEN '{label}'" for t, (label, _, _) in enumerate(TEMPLATES))
    listed = "array_join(array_sort(array_distinct(transform({}, h -> CASE h.t " + names + " END))), ',')"
    base = f"filter(found, h -> h.t < {BASE})"
    return out.select(
        "doc_id", "n_words",
        F.expr(f"cast(IF(found IS NULL, 0, size({base})) AS bigint)").alias("n_base"),
        F.expr(f"cast(array_min(transform({base}, h -> h.start)) AS bigint)").alias("first_word"),
        F.expr(f"cast(array_max(transform({base}, h -> h.start)) AS bigint)").alias("last_word"),
        F.expr(f"coalesce({listed.format(base)}, '')").alias("base_labels"),
        F.expr(f"coalesce({listed.format('found')}, '')").alias("labels"),
        F.expr("round(least(1D, coalesce(array_max(transform(found, h -> h.share)), 0D)), 6)").alias("score"),
    )


def _oracle() -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    rows = []
    for t, (label, notice, key) in enumerate(TEMPLATES):
        notice, key = notice.split(), key.split()
        rows.append(f"({t}, '{label}', {notice!r}, {key!r}, {key_offset(notice, key)})")
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
tmpl(t, label, notice, phrase, off) AS (VALUES {', '.join(rows)}),
vocab AS (SELECT DISTINCT x FROM (SELECT unnest(notice) AS x FROM tmpl)),
df AS (SELECT x, count(doc_id) AS n FROM vocab LEFT JOIN (SELECT DISTINCT doc_id, y FROM (SELECT doc_id, unnest(w) AS y FROM d)) AS e ON e.y = x GROUP BY x),
idf AS (SELECT x, ln(((SELECT count(*) FROM d) + 1) / (n + 1)) + 1e-6 AS v FROM df),
tw AS (SELECT t, k, notice[k + 1] AS x FROM tmpl, unnest(range(len(notice))) AS r(k)),
whole AS (SELECT t, sum(v) AS total FROM tw JOIN idf USING (x) GROUP BY t),
occ AS (SELECT doc_id, t, label, off, p, w FROM d, unnest(range(len(w))) AS r(p) JOIN tmpl ON w[p + 1] = phrase[1] AND w[p + 1 : p + len(phrase)] = phrase),
share AS (SELECT occ.doc_id, occ.t, occ.p, sum(CASE WHEN p - off + k >= 0 AND w[p - off + k + 1] = tw.x THEN v ELSE 0 END) / any_value(total) AS s
          FROM occ JOIN tw USING (t) JOIN idf USING (x) JOIN whole USING (t) GROUP BY occ.doc_id, occ.t, occ.p),
o AS (SELECT occ.doc_id, count(*) FILTER (t < {BASE}) AS n_base, min(p) FILTER (t < {BASE}) AS first_word, max(p) FILTER (t < {BASE}) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (t < {BASE}) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM occ GROUP BY occ.doc_id),
sc AS (SELECT doc_id, max(s) AS s FROM share GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(least(1.0, coalesce(s, 0.0)), 6) AS score
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN sc USING (doc_id)
"""


OP7_SQL = _oracle()
