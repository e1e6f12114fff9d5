"""Benchmark decontamination with suffix arrays over shards of the training text.

Each task cuts its documents into shards (``SHARD_BYTES`` of text) and builds one word-level suffix array per shard by
prefix doubling. Every suffix of every benchmark item is searched in it by binary search over whole suffixes, which
gives its longest verbatim match in the shard and where it is. What occurs of the item follows from that: a window of
the item occurs where the match of the suffix it begins is as long as the window, and all its places are the suffixes
around that match that share as many words. ``longest_matches`` returns the matches themselves, over all shards.

The benchmark is the stated query set: it is read in blocks of ``BLOCK_BYTES`` of text, one block is broadcast at a
time, and the documents are never shuffled. A suffix that starts with a word the block doesn't hold can't match and is
left out of the array; a run of known words shorter than the shortest window is left out as well. Both leave every
match of a window or more in place.

Edge cases: null or empty texts have no words (``n_hit`` 0, not contaminated); items without words have no window;
equal items and equal documents each keep their own row; an empty benchmark marks nothing; other columns are ignored,
but a column that is kept may not be named like one of the results (an error). Of several places of a longest match the
smallest document id counts, then the first word; a document without id comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, blocks, id_and_text

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
RESULT = ("_n_words", "_n_hit", "_spans", "_items")


def suffix_order(ids: np.ndarray, kept: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions ``kept`` of ``ids`` sorted by the suffixes that start there; over ``depth`` words, if given.

    Prefix doubling: after each round the rank tells suffixes apart by twice as many words. Word 0 ends a suffix. Rounds
    end when all suffixes are told apart or the longest is compared whole.
    """
    rank = np.zeros(len(ids) + 1, np.int64)
    rank[:-1] = ids
    width = 1
    longest = int(runs_left(ids)[kept].max(initial=0)) if depth is None else depth
    while width < longest:
        ahead = np.minimum(kept + width, len(ids))
        key = (rank[kept] << 32) | np.where(rank[kept] > 0, rank[ahead], 0)
        # a suffix that isn't kept has rank by its first word only, which is never needed: it can't be inside a window
        different, inverse = np.unique(key, return_inverse=True)
        rank[:] = 0
        rank[kept] = inverse + 1
        width *= 2
        if len(different) == len(kept):
            break
    return kept[np.argsort(rank[kept], kind="stable")]


def runs_left(ids: np.ndarray) -> np.ndarray:
    """For each position, how many words follow from there (itself included) before the next 0."""
    stops = np.append(np.flatnonzero(ids == 0), len(ids))
    at = np.arange(len(ids))
    return stops[np.searchsorted(stops, at)] - at


def common_words(text: np.ndarray, a: np.ndarray, query: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words ``text`` from ``a`` and ``query`` from ``b`` share, ``most`` at most; word 0 is shared by none."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    k = 0
    while len(live):
        x = text[np.minimum(a[live] + k, len(text) - 1)]
        live = live[(a[live] + k < len(text)) & (x > 0) & (x == query[b[live] + k])]
        k += 1
        out[live] = k
        live = live[k < most[live]]
    return out


def best_matches(
    text: np.ndarray, order: np.ndarray, query: np.ndarray, at: np.ndarray, reach: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each query suffix (``reach`` words of ``query`` from ``at``): the place in ``order`` of a suffix of ``text``
    that shares most words with it, and their number. Binary search over whole suffixes, all queries at once."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    for _ in range(int(len(order)).bit_length()):
        mid = np.minimum((lo + hi) >> 1, len(order) - 1)
        pos = order[mid]
        same = common_words(text, pos, query, at, reach)
        ends = same >= reach  # the query is a prefix: it comes first
        a = text[np.minimum(pos + same, len(text) - 1)] * (pos + same < len(text))
        b = query[np.minimum(at + same, len(query) - 1)]
        before = ~ends & (a < b) & (lo < hi)
        lo, hi = np.where(before, mid + 1, lo), np.where(before | (lo >= hi), hi, mid)
    left, right = np.maximum(lo - 1, 0), np.minimum(lo, len(order) - 1)
    shared = [common_words(text, order[p], query, at, reach) for p in (left, right)]
    return np.where(shared[0] > shared[1], left, right), np.maximum(*shared)


def neighbours(text: np.ndarray, order: np.ndarray, words: int) -> np.ndarray:
    """For each place of ``order`` the number of its group: places whose suffixes share their first ``words`` words."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    shared = common_words(text, order[1:], text, order[:-1], np.full(len(order) - 1, words))
    return np.cumsum(np.append(0, shared < words))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split() if text else []


def test_index(items: list[tuple[object, bytes | None]], window: int) -> dict:
    """Word numbers, suffixes, distinct windows and the items of each window of one benchmark block."""
    vocabulary: dict[bytes, int] = {}
    flat: list[int] = []
    windows: dict[tuple[int, ...], int] = {}
    at, length, owners = [], [], []  # of the windows
    suffix, reach, item_of, place = [], [], [], []  # of the suffixes that hold a window
    for item, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
        n = min(window, len(numbers))
        base = len(flat)
        flat += numbers
        for i in range(len(numbers) - n + 1 if n else 0):
            key = tuple(numbers[i : i + n])
            j = windows.setdefault(key, len(windows))
            if j == len(at):
                at.append(len(suffix))
                length.append(n)
                owners.append(set())
            owners[j].add(str(item))
            suffix.append(base + i)
            reach.append(len(numbers) - i)
            item_of.append(item)
            place.append(i)
    numbers_of = lambda x: np.array(x, np.int64)
    return {
        "vocabulary": vocabulary, "query": numbers_of(flat), "suffix": numbers_of(suffix), "reach": numbers_of(reach), "item": item_of,
        "place": numbers_of(place), "least": np.minimum(window, numbers_of(reach) + numbers_of(place)), "at": numbers_of(at),
        "length": numbers_of(length), "owners": [sorted(o) for o in owners],
    }


def shard(texts: list[bytes | None], index: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers of the shard with 0 between documents, first word of each document, suffix array)."""
    get = index["vocabulary"].get
    flat: list[int] = []
    first = []
    for t in texts:
        first.append(len(flat))
        flat += [get(w, 0) for w in words(t)]
        flat.append(0)
    first.append(len(flat))
    ids = np.array(flat, np.int64)
    order = np.zeros(0, np.int64)
    if len(index["at"]):
        shortest = int(index["length"].min())
        left = runs_left(ids)
        if (left >= shortest).any():
            # ranks are needed for every known word inside a kept suffix, so all known words of such runs are ordered
            order = suffix_order(ids, np.flatnonzero((ids > 0) & _near(left, ids, shortest)))
    return ids, np.array(first, np.int64), order


def shard_hits(texts: list[bytes | None], index: dict) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, int, int]]]:
    """(word numbers of the shard, first word of each document, (positions, window, length) of the windows that occur)."""
    ids, first, order = shard(texts, index)
    found: list[tuple[np.ndarray, int, int]] = []
    if len(order):
        best, shared = best_matches(ids, order, index["query"], index["suffix"], index["reach"])
        best, long_enough = best[index["at"]], shared[index["at"]] >= index["length"]
        for n in np.unique(index["length"][long_enough]).tolist():
            group = neighbours(ids, order, n)
            own = np.flatnonzero(long_enough & (index["length"] == n))
            lo, hi = (np.searchsorted(group, group[best[own]], side) for side in ("left", "right"))
            found += [(order[a:b], int(j), n) for a, b, j in zip(lo.tolist(), hi.tolist(), own.tolist(), strict=True)]
    return ids, first, found


def _near(left: np.ndarray, ids: np.ndarray, shortest: int) -> np.ndarray:
    """Known words that lie in a run of at least ``shortest`` known words."""
    stops = np.flatnonzero(np.append(0, ids) == 0)  # a stop before the first word
    start = stops[np.searchsorted(stops, np.arange(1, len(ids) + 1), side="left") - 1]
    start = np.minimum(start, len(ids) - 1)
    return left[start] >= shortest


def _hits(index: dict, shard_bytes: int, keep: list[str], again: bool):
    """``again``: the rows hold what the blocks before this one have found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, shard_bytes):
            ids, first, found = shard_hits(texts, index)
            cover = np.zeros(len(ids) + 1, np.int64)
            owners: dict[int, set[str]] = {}
            for pos, j, n in found:
                cover[pos] += 1
                cover[pos + n] -= 1
                for d in np.unique(np.searchsorted(first, pos, side="right") - 1).tolist():
                    owners.setdefault(d, set()).update(index["owners"][j])
            spans = [_spans(cover, first, d) if d in owners else [] for d in range(len(texts))]
            items = [sorted(owners.get(d, ())) for d in range(len(texts))]
            if again:
                spans = [_merged(x, y) for x, y in zip(rows.column("_spans").to_pylist(), spans, strict=True)]
                items = [sorted({*x, *y}) for x, y in zip(rows.column("_items").to_pylist(), items, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(n) for n in keep),
                    pa.array(first[1:] - first[:-1] - 1, pa.int64()),
                    pa.array([sum(x[1::2]) - sum(x[::2]) for x in spans], pa.int64()),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*keep, *RESULT],
            )

    return run


def _merged(x: list[int], y: list[int]) -> list[int]:
    """Union of two lists of start, end, start, end ..."""
    flat: list[int] = []
    for s, e in sorted([*zip(x[::2], x[1::2], strict=True), *zip(y[::2], y[1::2], strict=True)]):
        if flat and s <= flat[-1]:
            flat[-1] = max(flat[-1], e)
        else:
            flat += [s, e]
    return flat


def _spans(cover: np.ndarray, first: np.ndarray, d: int) -> list[int]:
    """Covered words of document ``d`` as start, end, start, end ... (words from 0, end exclusive)."""
    hit = (np.cumsum(cover[: first[d + 1] + 1])[first[d] :] > 0).astype(np.int8)
    return np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]))).tolist()


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, bytes | None]]]:
    """Benchmark items in blocks of ``block_bytes`` of text; the driver holds one partition's rows at a time."""
    block: list[tuple[object, bytes | None]] = []
    size = 0
    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        text = row.text.encode() if row.text is not None else None
        block.append((row.item_id, text))
        size += len(text or b"")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None,
    shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with ``_n_words``, ``_n_hit``, ``_spans`` (hit word ranges) and
    ``_items`` (ids as sorted strings). One narrow pass over the documents per benchmark block; with several blocks what
    one pass has found travels with the row to the next, so rows need no key and repeated ids stay apart.
    """
    keep = docs.columns if keep is None else keep
    if {*RESULT} & {*keep}:
        raise ValueError(f"columns {sorted({*RESULT} & {*keep})} can't be kept beside the results")
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    out, blocks_left = docs, benchmark_blocks(benchmark, block_bytes)
    block, again = next(blocks_left, []), False
    while True:
        following = next(blocks_left, None)
        names = keep if following is None else docs.columns
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields]
        out = out.mapInArrow(
            _hits(test_index(block, window), shard_bytes, names, again),
            ", ".join([*fields, "_n_words long", "_n_hit long", "_spans array<bigint>", "_items array<string>"]),
        )
        if following is None:
            return out
        block, again = following, True


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id (as text), item_word, n_words, doc_id, doc_word: for every suffix of every item (words from 0) its longest
    verbatim match in ``docs`` and the place of it, if it is as long as a window. Rows of equal items are one."""
    docs = id_and_text(docs)
    schema = "item_id string, item_word long, n_words long, doc_id long, doc_word long"

    def search(index: dict):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, texts in blocks(batches, shard_bytes):
                ids, first, order = shard(texts, index)
                if not len(order):
                    continue
                best, shared = best_matches(ids, order, index["query"], index["suffix"], index["reach"])
                doc_ids = rows.column("doc_id").to_pylist()
                groups: dict[int, np.ndarray] = {}
                out: list[tuple] = []
                for k in np.flatnonzero(shared >= index["least"]).tolist():
                    n = int(shared[k])
                    if n not in groups:
                        groups[n] = neighbours(ids, order, n)
                    lo, hi = (np.searchsorted(groups[n], groups[n][best[k]], side) for side in ("left", "right"))
                    places = order[lo:hi]  # all places of the longest match
                    owner = np.searchsorted(first, places, side="right") - 1
                    where = [(doc_ids[d] is None, doc_ids[d] or 0, w) for d, w in zip(owner.tolist(), (places - first[owner]).tolist(), strict=True)]
                    none, doc, word = min(where)
                    out.append((str(index["item"][k]), int(index["place"][k]), n, None if none else doc, word))
                columns = zip(*out, strict=True) if out else [[]] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*c], t) for c, t in zip(columns, kinds, strict=True)], names=["item_id", "item_word", "n_words", "doc_id", "doc_word"]
                )

        return run

    found = None
    for block in benchmark_blocks(benchmark, block_bytes):
        own = docs.mapInArrow(search(test_index(block, window)), schema)
        found = own if found is None else found.union(own)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    first = F.min(F.struct(-F.col("n_words"), F.col("doc_id").isNull(), "doc_id", "doc_word")).alias("b")
    best = found.groupBy("item_id", "item_word").agg(first)
    return best.select("item_id", "item_word", (-F.col("b.col1")).alias("n_words"), "b.doc_id", "b.doc_word")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of a benchmark item occurs; one filter per block."""

    def clean(index: dict):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, texts in blocks(batches, SHARD_BYTES):
                _, first, found = shard_hits(texts, index)
                free = np.ones(len(texts), bool)
                for pos, _, _ in found:
                    free[np.searchsorted(first, pos, side="right") - 1] = False
                yield rows.filter(pa.array(free))

        return run

    out = docs
    for block in benchmark_blocks(benchmark, block_bytes):
        out = out.mapInArrow(clean(test_index(block, window)), docs.schema)
    return out


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with the digest columns of the contract."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = b.column("_items").to_pylist()
            hits = b.column("_n_hit").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), b.column("_n_words"), b.column("_n_hit"),
                    pa.array([len(i) for i in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                    pa.array([h > 0 for h in hits]),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    found = contamination(id_and_text(docs), benchmark, keep=["doc_id"])
    return found.mapInArrow(
        digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )


#: DuckDB: every 10-word window of an item against the 10-word windows of the documents.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
n AS (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS k FROM n, unnest(range(1, len(w) - n + 2)) AS t(p)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(p)),
m AS (SELECT dw.doc_id, dw.p, dw.n, win.item_id FROM dw JOIN win USING (n, k)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM m, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
