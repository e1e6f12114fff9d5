"""Quality rules with an n-gram perplexity model.

Base rules (length, repeated 8-word windows) come first. The verdict adds perplexity: an interpolated modified
Kneser-Ney model of order ``ORDER`` over text symbols, whose n-gram counts Spark sums over all documents. Symbols have
``BITS`` bits (a-z, digits, punctuation, other bytes in classes), so an n-gram is one number and the model holds at most
2**(ORDER * BITS) entries of 12 bytes: that bound (201 MB; a corpus in four languages needs about 5 MB) is why it may
be sent to every task. It is stored in arrays sorted by hashed n-gram and read by binary search.

Each language has a lower and an upper bound of log perplexity: median less / plus ``WIDTH`` robust deviations, taken
from an exact histogram (steps of 1/``STEPS``) over the distinct texts that pass the base rules. Copies count once in it;
in the model's counts too, every one of c copies with the weight 1/c (the copies of each repeated text, by hash, are
broadcast up to ``BROADCAST_ROWS`` texts and joined with a shuffle beyond; the counts are the same).
Texts differ by topic and style, whatever their length, and by the sampling noise of their symbols, which shrinks with
the length: a text of n symbols is held against ``WIDTH`` times sqrt(between**2 + symbol**2 / n). Both parts come from
the robust deviations of the length classes of a language; the width is ``LEAST`` at least.

Four passes over the documents, three small shuffles (text hashes, n-grams, histogram); rows are judged where they lie, so repeated
or null ids keep their own verdict.

Edge cases: a null or empty text has no words and fails; a null language is a language of its own; a language without any
scatter or with fewer than ``FEWEST`` distinct texts can't be judged and has no bounds; an empty table gives an empty model and no rows;
other columns are ignored by the operator and kept by ``accepted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix, span_hashes, stored, temporary, words_of

ORDER, BITS = 4, 6
STEPS = 1000
WIDTH, LEAST = 6.0, 0.15
FEWEST, FEWEST_OF_SIZE = 20, 8
BROADCAST_ROWS = 4_000_000  # of 16 bytes
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
BLOCK_BYTES = 1 << 20
SYMBOLS = "#*$%&|<>"
NO_LANGUAGE = "\x00"
_HASH = 0x9E3779B1  # odd: a one-to-one hash of 32-bit numbers


def symbol_table() -> np.ndarray:
    """Symbol of each byte: 0 white space, 1-26 letters, 27 digits, 28-37 punctuation, 38-63 other bytes in classes."""
    table = np.zeros(256, np.uint32)
    for b in range(256):
        c = chr(b).lower()
        if b >= 128:
            table[b] = 38 + b % 26
        elif "a" <= c <= "z":
            table[b] = ord(c) - 96
        elif c.isdigit():
            table[b] = 27
        elif b > 32:
            table[b] = 28 + b % 10
    return table


def ngrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-gram ending at each symbol, number of symbols of each text); white space collapsed, texts apart."""
    gap = b" " * (ORDER - 1)
    lens = np.array([len(t or b"") for t in texts], np.int64) + len(gap)
    buf = np.frombuffer(gap.join([b"", *(t or b"" for t in texts)]) + b" ", np.uint8)  # gap before each, one end after
    owner_start = np.cumsum(np.append(0, lens))
    s = symbol_table()[buf]
    stay = np.ones(len(s), bool)
    stay[1:] = (s[1:] != 0) | (s[:-1] != 0)
    head = owner_start[:-1]
    for k in range(len(gap)):  # the gap before each text stays whole
        stay[head + k] = True
    kept = s[stay]
    at = np.cumsum(np.append(0, stay))[np.append(head, len(buf) - 1)]  # place of each text's gap among the kept
    key = kept.copy()
    for k in range(1, ORDER):
        key[k:] |= kept[:-k] << np.uint32(BITS * k)
    body = np.ones(len(kept), bool)
    for k in range(len(gap)):
        body[at[:-1] + k] = False
    body[at[-1] :] = False
    return key[body], np.diff(at) - len(gap)


def _with_copies(docs: DataFrame) -> DataFrame:
    """(text, copies): every row with the number of rows that have its text."""
    hashed = F.xxhash64("text").alias("hash")
    many = docs.where("text IS NOT NULL").groupBy(hashed).agg(F.count("*").alias("copies")).where("copies > 1")
    many = stored(many, "copies")
    if many.count() <= BROADCAST_ROWS:
        many = F.broadcast(many)
    return docs.select("text", hashed).join(many, "hash", "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))


def count_ngrams(docs: DataFrame) -> pd.DataFrame:
    """Counts of the n-grams of the distinct texts of ``docs``; at most 2**(ORDER * BITS) rows, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint32)], [np.zeros(0)]

        def merge() -> None:
            key, where = np.unique(np.concatenate(keys), return_inverse=True)
            count = np.bincount(where, weights=np.concatenate(counts), minlength=len(key))
            keys[:], counts[:] = [key], [count]

        for rows, texts in blocks(batches, BLOCK_BYTES):
            copies = rows.column("copies").to_numpy()
            for c in np.unique(copies).tolist():
                key, count = np.unique(ngrams([texts[i] for i in np.flatnonzero(copies == c)])[0], return_counts=True)
                keys.append(key)
                counts.append(count / c)
            if len(keys) > 16:
                merge()
        merge()
        for lo in range(0, len(keys[0]), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_pydict({"key": keys[0][part].astype(np.int32), "n": counts[0][part]})

    with temporary(docs.sparkSession):
        # the weights of a text's copies add up to one
        counted = _with_copies(docs).mapInArrow(run, "key int, n double").groupBy("key")
        return counted.agg(F.round(F.sum("n")).cast("long").alias("n")).toPandas()


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, 3 and more."""
    n1, n2, n3, n4 = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(d, [0.0, 0.05, 0.05, 0.05], [0.0, 0.95, 1.95, 2.95])


def fit(counts: pd.DataFrame) -> dict:
    """The model from the counts: per order sorted hashed n-grams with log probability, and the back-off of contexts."""
    key = counts["key"].to_numpy(np.int64)
    n = counts["n"].to_numpy(np.int64)
    order = np.argsort(key)
    key, n = key[order], n[order]
    levels = [(key, n)]
    for k in range(ORDER - 1, 0, -1):  # lower orders count the different symbols seen before an n-gram
        key, n = np.unique(levels[-1][0] & ((1 << (BITS * k)) - 1), return_counts=True)
        levels.append((key, n))
    tables: list[dict] = []
    lower = None
    for key, n in reversed(levels):
        context = key >> BITS
        ctx, start = np.unique(context, return_index=True)
        where = np.searchsorted(ctx, context)
        total = np.add.reduceat(n, start) if len(start) else np.zeros(0, np.int64)
        d = _discounts(n)[np.minimum(n, 3)]
        spare = (np.add.reduceat(d, start) if len(start) else np.zeros(0)) / np.maximum(total, 1)
        k = len(tables)
        below = np.full(len(key), 1.0 / (1 << BITS)) if lower is None else lower[1][np.searchsorted(lower[0], key & ((1 << (BITS * k)) - 1))]
        p = (n - d) / np.maximum(total, 1)[where] + spare[where] * below if len(key) else np.zeros(0)
        lower = (key, p)
        tables.append({"ngram": _table(key, np.log(p)), "context": _table(ctx, np.log(np.maximum(spare, 1e-12)))})
    return {"tables": tables, "unseen": float(-BITS * np.log(2))}


def _table(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed = (key * _HASH & 0xFFFFFFFF).astype(np.uint32)
    order = np.argsort(hashed)
    return hashed[order], value[order].astype(np.float32)


def _find(table: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed = key.astype(np.uint32) * np.uint32(_HASH)
    if not len(table[0]):
        return np.zeros(len(key), bool), np.zeros(len(key), np.float32)
    at = np.minimum(np.searchsorted(table[0], hashed), len(table[0]) - 1)
    return table[0][at] == hashed, table[1][at]


def log_probability(model: dict, key: np.ndarray) -> np.ndarray:
    """Natural log probability of the last symbol of each packed n-gram after the symbols before it."""
    out = np.zeros(len(key), np.float32)
    left = np.arange(len(key))
    for k in range(ORDER, 0, -1):
        low = key[left] & np.uint32((1 << (BITS * k)) - 1)
        table = model["tables"][k - 1]
        found, value = _find(table["ngram"], low)
        out[left[found]] += value[found]
        left, low = left[~found], low[~found]
        if not len(left):
            return out
        found, value = _find(table["context"], low >> np.uint32(BITS))
        out[left[found]] += value[found]
    out[left] += model["unseen"]
    return out


def log_perplexity(model: dict, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(mean negative log probability per symbol, number of symbols) of each text; 0 where it has none."""
    key, n = ngrams(texts)
    total = np.concatenate([[0.0], np.cumsum(log_probability(model, key), dtype=np.float64)])
    ends = np.cumsum(n)
    # each text's sum is rounded so that it doesn't depend on its neighbours in the block
    return np.round(-(total[ends] - total[ends - n]) / np.maximum(n, 1), 6), n


def size_class(n: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(n, 1)).astype(np.int32)


def _language(rows: pa.RecordBatch) -> list[str]:
    """The language each row is judged in: null is one of its own, and so is the empty name."""
    if "lang" not in rows.schema.names:
        return [NO_LANGUAGE] * rows.num_rows
    return [NO_LANGUAGE if x is None else x for x in rows.column("lang").to_pylist()]


def base_counts(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    buf, starts, ends, first = words_of(texts)
    n = np.diff(first)
    points = np.cumsum(np.append(0, (buf & 0xC0) != 0x80))  # code points before each byte
    chars = np.cumsum(np.append(0, points[ends] - points[starts]))
    wanted = np.zeros(256, np.int64)
    wanted[list(SYMBOLS.encode())] = 1
    symbols = np.cumsum(np.append(0, wanted[buf]))
    at = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    dup = []
    for t in texts:
        lines = [x for x in (t or b"").split(b"\n") if x and x.strip()]
        dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": n, "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": symbols[np.minimum(at[1:], len(buf))] - symbols[at[:-1]],
        "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": _repeats(span_hashes(buf, starts, ends), first),
    }


def _repeats(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words inside windows of ``WINDOW`` words that occur twice or more in their text."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    cover = np.zeros(len(word) + 1, np.int64)
    m = len(word) - WINDOW + 1
    if m > 0:
        key = np.zeros(m, np.uint64)
        for k in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + word[k : k + m]
        key = mix(key) + owner[:m] * np.uint64(0xD6E8FEB86659FD93)
        at = np.flatnonzero(owner[:m] == owner[WINDOW - 1 :])  # windows inside one text
        order = at[np.argsort(key[at], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        again = order[np.append(same, False) | np.append(False, same)]
        cover[again] += 1
        cover[again + WINDOW] -= 1
    inside = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    return inside[first[1:]] - inside[first[:-1]]


def failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def fit_bands(docs: DataFrame, model: dict) -> dict[str, dict]:
    """Per language the median log perplexity and the robust deviations between texts and of one symbol, over distinct texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, BLOCK_BYTES):
            value, n = log_perplexity(model, texts)
            counts = base_counts(texts)
            use = ~failed(counts["n_words"], counts["n_repeat_words"])
            bins = pd.DataFrame({
                "lang": _language(rows), "size": size_class(n), "bin": np.floor(value * STEPS).astype(np.int32),
                "hash": rows.column("hash").to_numpy(),
            })[use]
            yield pa.RecordBatch.from_pandas(bins.drop_duplicates(), preserve_index=False)

    own_columns = [c for c in ("text", "lang") if c in docs.columns]
    found = docs.select(*own_columns, F.xxhash64("text").alias("hash")).mapInArrow(run, "lang string, size int, bin int, hash long")
    table = found.distinct().groupBy("lang", "size", "bin").agg(F.count("*").alias("n")).toPandas()
    bands = {}
    for lang, own in table.groupby("lang"):
        if own["n"].sum() < FEWEST:
            continue
        middle = _median(own["bin"].to_numpy() / STEPS, own["n"].to_numpy())
        between, symbol = _deviations(np.abs(own["bin"].to_numpy() / STEPS - middle), own["size"].to_numpy(), own["n"].to_numpy())
        if between > 0 or symbol > 0:
            bands[str(lang)] = {"median": middle, "between": between, "symbol": symbol}
    return bands


def _deviations(away: np.ndarray, size: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Robust deviations (between texts, of a symbol) of texts ``away`` from the median, ``weight`` of them each.

    The squared deviation of a length class is between**2 + symbol**2 / length: least squares over the classes, relative
    errors. With a single class of ``FEWEST_OF_SIZE`` texts the parts can't be told apart, and each is the whole.
    """
    length = 2.0 ** (size + 0.5)
    y, x, m = [], [], []
    for k in np.unique(size):
        own = size == k
        if weight[own].sum() >= FEWEST_OF_SIZE:
            y.append(max(1.4826 * _median(away[own], weight[own]), 1 / STEPS) ** 2)
            x.append(2.0 ** -(k + 0.5))
            m.append(weight[own].sum())
    if len(y) < 2:
        return 1.4826 * _median(away, weight), 1.4826 * _median(away * np.sqrt(length), weight)
    y, x = np.array(y), np.array(x)
    w = np.array(m) / y**2
    mean_x, mean_y = (w * x).sum() / w.sum(), (w * y).sum() / w.sum()
    slope = (w * (x - mean_x) * (y - mean_y)).sum() / (w * (x - mean_x) ** 2).sum()
    level = mean_y - slope * mean_x
    if slope < 0:
        slope, level = 0.0, mean_y
    elif level < 0:
        slope, level = (w * x * y).sum() / (w * x * x).sum(), 0.0
    return float(np.sqrt(level)), float(np.sqrt(slope))


def _median(value: np.ndarray, weight: np.ndarray) -> float:
    order = np.argsort(value, kind="stable")
    sums = np.cumsum(weight[order])
    return float(value[order][np.searchsorted(sums, (sums[-1] + 1) // 2)])


def limits(bands: dict[str, dict], lang: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of log perplexity of each document of ``n`` symbols."""
    none = {"median": 0.0, "between": np.inf, "symbol": 0.0}
    own = [bands.get(x, none) for x in lang]
    middle = np.array([b["median"] for b in own])
    between, symbol = (np.array([b[k] for b in own]) for k in ("between", "symbol"))
    width = np.maximum(LEAST, WIDTH * np.sqrt(between**2 + symbol**2 / np.maximum(n, 1)))
    return middle - width, middle + width


def verdicts(rows: pa.RecordBatch, texts: list[bytes | None], model: dict, bands: dict):
    """(base counts, base rules failed, kept, (log perplexity, lower bound, upper bound)) of the rows of a batch."""
    value, n = log_perplexity(model, texts)
    counts = base_counts(texts)
    bad = failed(counts["n_words"], counts["n_repeat_words"])
    low, high = limits(bands, _language(rows), n)
    return counts, bad, ~bad & (value >= low) & (value <= high), (value, low, high)


def judged(docs: DataFrame, keep: list[str] | None = None, model: dict | None = None, bands: dict | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with the base counts, ``_perplexity``, the bounds and ``_kept``."""
    keep = docs.columns if keep is None else keep
    made = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_base_failed", "_kept", "_perplexity", "_low", "_high"]
    if {*made} & {*keep}:
        raise ValueError(f"columns {sorted({*made} & {*keep})} can't be kept beside those the verdict adds")
    model = fit(count_ngrams(docs)) if model is None else model
    bands = fit_bands(docs, model) if bands is None else bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, BLOCK_BYTES):
            counts, bad, kept, logs = verdicts(rows, texts, model, bands)
            arrays = [pa.array(v, pa.int64()) for v in counts.values()]
            more = [pa.array(bad), pa.array(kept), *(pa.array(np.exp(v)) for v in logs)]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), *arrays, *more],
                names=[*keep, *(f"_{c}" for c in counts), "_base_failed", "_kept", "_perplexity", "_low", "_high"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    made = "_n_words long, _word_chars long, _n_symbols long, _n_dup_lines long, _n_repeat_words long, _base_failed boolean, _kept boolean, _perplexity double, _low double, _high double"
    return docs.mapInArrow(run, ", ".join([*fields, made]))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base rules and lie inside their language's band."""
    model = fit(count_ngrams(docs))
    bands = fit_bands(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, BLOCK_BYTES):
            yield rows.filter(pa.array(verdicts(rows, texts, model, bands)[2]))

    return docs.mapInArrow(run, docs.schema)


def op6(docs: DataFrame) -> DataFrame:
    """Columns of the contract, one row per document; ``perplexity`` and its bounds follow."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang"),
    )
    out = judged(rows, keep=["doc_id"])
    return out.select("doc_id", *(F.col(f"_{re.sub('^_', '', c)}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity"
    )))
