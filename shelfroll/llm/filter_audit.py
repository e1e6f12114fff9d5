"""Filter interaction audit by count-weighted decision diagrams.

Five filters look at a document; what each of them removes depends on the filters before it. Every document is reduced
to the mask of the filters it fails, and masks are counted per part, together with the documents of good quality and the
toxic ones. A part has at most 32 masks, whatever its size; they become one decision diagram whose levels are the filters
and whose leaves are counts. Equal sub-diagrams are held once. All orders of the filters are visited by swaps of two
adjacent levels, each of which rebuilds those two levels alone; in the diagram of an order the path on which every
filter passes is the run of that order: the pass branch of a level has what is kept, the fail branch what is removed.

``identical text`` (E) is settled without bringing the copies of a text together: the least id of each text digest is
an aggregate with partial sums, and it is joined back on digest *and* id, so that a group of copies, however large, is
spread like any other rows.

Edge cases: a null text is the empty text (both are copies of each other); a null source is the part ``''``, as is an
empty one; a document without id neither is a copy nor makes others copies, and has no label; repeated rows count each,
and rows that share the least id of a text are no copies; a document with several label rows is good (toxic) if one of
them says so; other columns are not read; no documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the audit: filters in the order of their bits, and what D looks for.
FILTERS = "ABCDE"
JUNK = "[#$%&*|]"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2

Counts = tuple[int, int, int]  # documents, those of good quality, toxic ones
NONE: Counts = (0, 0, 0)


def failures(text: Column) -> Column:
    """The mask of A to D (bits 0 to 3) that a non-null text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]++"), "")
    n, chars = F.size(words), F.length(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]++", ""))
    few, same = n < LEAST_WORDS, 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * n.cast("long")
    loud, junk = 100 * capitals.cast("long") > CAPITAL_PERCENT * chars.cast("long"), text.rlike(JUNK)
    bit = lambda cond, value: F.when(cond, value).otherwise(0)
    return bit(few, 1) + bit(same, 2) + bit(loud, 4) + bit(junk, 8)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the mask of filters they fail; 32 rows a part at most."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seen = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), failures(F.col("text")).alias("mask"))
    # repeated rows of an id are summed first: the joins below have one row of an id, text and part. Texts are read once
    seen = stored(seen.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")), "masks")
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("key"), F.lit(True).alias("has_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    # rows without id are dealt by their digest, for all of them together could be too many for a task
    rows = seen.withColumns({"key": F.coalesce("id", F.xxhash64("digest")), "has_id": F.col("id").isNotNull()})
    rows = rows.join(marks, ["key", "has_id"], "left")
    least = seen.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.lit(True).alias("least"))
    rows = rows.join(least, ["digest", "id"], "left")
    copy = F.when(F.col("id").isNotNull() & F.col("least").isNull(), 16).otherwise(0)
    return rows.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


class Diagram:
    """A count-weighted decision diagram over failure masks.

    A node is a pair (pass branch, fail branch) of the next level's nodes; below the last level stand counts. ``None``
    is the diagram without documents. Equal nodes are one object (``nodes``), so a swap rebuilds each only once.
    """

    def __init__(self, masks: dict[int, Counts], filters: int):
        self.order = list(range(filters))
        self.nodes: dict[tuple, tuple] = {}
        self.root = self._build(masks, 0)

    def _node(self, passed, failed):
        if passed is None and failed is None:
            return None
        return self.nodes.setdefault((id(passed), id(failed)), (passed, failed))

    def _leaf(self, counts: Counts):
        return self.nodes.setdefault(counts, counts) if any(counts) else None

    def _build(self, masks: dict[int, Counts], level: int):
        if not masks:
            return None
        if level == len(self.order):
            return self._leaf(next(iter(masks.values())))
        bit = 1 << self.order[level]
        passed = {m: c for m, c in masks.items() if not m & bit}
        failed = {m: c for m, c in masks.items() if m & bit}
        return self._node(self._build(passed, level + 1), self._build(failed, level + 1))

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and ``level + 1``; nodes above are led to the rebuilt ones, those below stay."""
        done: dict[int, object] = {}

        def rebuilt(node, depth: int):
            if node is None:
                return None
            if id(node) not in done:
                if depth < level:
                    done[id(node)] = self._node(rebuilt(node[0], depth + 1), rebuilt(node[1], depth + 1))
                else:
                    (pp, pf), (fp, ff) = node[0] or (None, None), node[1] or (None, None)
                    done[id(node)] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[id(node)]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def counts(self, node, depth: int, memo: dict) -> Counts:
        """All documents below a node of level ``depth``."""
        if node is None:
            return NONE
        if depth == len(self.order):
            return node
        if (id(node), depth) not in memo:
            a, b = self.counts(node[0], depth + 1, memo), self.counts(node[1], depth + 1, memo)
            memo[id(node), depth] = (a[0] + b[0], a[1] + b[1], a[2] + b[2])
        return memo[id(node), depth]

    def steps(self) -> list[tuple[Counts, Counts]]:
        """(kept, removed) at each level of the path on which every filter passes."""
        out, node, memo = [], self.root, {}
        for depth in range(len(self.order)):
            passed, failed = node if node is not None else (None, None)
            out.append((self.counts(passed, depth + 1, memo), self.counts(failed, depth + 1, memo)))
            node = passed
        return out

    def only(self) -> list[int]:
        """Documents that fail one filter alone, by level."""
        out, node = [], self.root
        for depth in range(len(self.order)):
            passed, rest = node if node is not None else (None, None)
            for _ in range(depth + 1, len(self.order)):
                rest = rest[0] if rest is not None else None
            out.append(rest[0] if rest is not None else 0)
            node = passed
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one, so that every order of ``n`` things is met once after the first order."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + down  # the travelling thing stands at the low end after going down
        down = not down


def audit(masks: dict[int, Counts], filters: str = FILTERS) -> list[tuple]:
    """(order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    diagram = Diagram(masks, len(filters))
    failing = [sum(c[0] for m, c in masks.items() if m >> f & 1) for f in range(len(filters))]
    alone = dict(zip(diagram.order, diagram.only(), strict=True))
    shapley = [0] * len(filters)
    found = []

    def visit() -> None:
        order = "".join(filters[f] for f in diagram.order)
        for step, (f, (kept, removed)) in enumerate(zip(diagram.order, diagram.steps(), strict=True), 1):
            shapley[f] += removed[0]
            found.append((order, step, f, kept[0], removed[0], failing[f] - removed[0], alone[f], removed[1], removed[2]))

    visit()
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        visit()
    assert len(found) == math.factorial(len(filters)) * len(filters)
    return [(o, step, filters[f], *rest, shapley[f]) for o, step, f, *rest in found]


COLUMNS = ["filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDIT_SCHEMA = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audited(masks: DataFrame) -> DataFrame:
    """The audit of every part of (part, mask, n, good, toxic): one row per order and step."""
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("part", pa.string())]
            + [(c, pa.string() if c in ("filter_order", "filter") else pa.int32() if c == "step" else pa.int64()) for c in COLUMNS]
        )
        for batch in batches:
            for part, own in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                rows = audit({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in own})
                columns = [pa.array([part] * len(rows), pa.string())]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return parts.mapInArrow(run, AUDIT_SCHEMA)


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns of the contract: parts are the values of ``source``."""
    return audited(mask_counts(docs, labels))


OP11_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), least AS (
  SELECT text, min(doc_id) AS least_id FROM base GROUP BY text
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
       + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
       + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
       + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
       + CASE WHEN least_id < doc_id THEN 16 ELSE 0 END AS mask
  FROM base JOIN least USING (text) LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS filter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.filter || b.filter || c.filter || d.filter || e.filter AS filter_order
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
       JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), steps AS (
  SELECT filter_order, step, filter, bit,
         coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders) JOIN letters ON filter = substr(filter_order, step, 1)
), found AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM masks CROSS JOIN steps GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
FROM found
"""
