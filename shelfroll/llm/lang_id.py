"""Language identification with error-correcting output codes.

Every language has a codeword of +1 / -1 bits. For each bit a binary classifier over byte n-grams (one to three bytes,
ASCII lower-cased, everything but letters and bytes of other scripts a blank) decides between the languages that have +1
and those that have -1: its weights are log ratios of the two groups' smoothed n-gram shares, every language counting
alike. Decoding is loss-weighted: a language's loss is the sum over bits of the logistic loss of the margin against its
codeword, weighted by the bit's accuracy on the training documents. The nearest codeword wins; the document is flagged
ambiguous where the runner-up is nearly as near.

Counts cover all training documents: one pass that sums n-grams per language on the executors, a second that measures
each bit's accuracy and margins. The model has languages x FEATURES numbers (131,328 each): it grows with the number of
languages, never with the documents.

Edge cases: null texts and texts without a letter get ``und`` with score 0; without any labelled document all do; one
language only wins always; null languages are not learned from; other columns are ignored; repeated ids keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, crc_mod

HASHED = 1 << 16
FEATURES = 256 + (1 << 16) + HASHED
SMOOTHING = 0.5
MIN_MARGIN = 0.05  # share of the greatest possible distance below which a decision is ambiguous
BLOCK_BYTES = 1 << 20
_GAP = b"   "

#: Letters lower-cased, bytes of other scripts kept, all else a blank.
CLEAN = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """Codewords (languages x bits) of +1 / -1, no column constant: all distinct splits for up to six languages, else
    the widest of 200 random codes of 10 * log2(languages) bits."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 6:
        splits = np.arange(1, 1 << (languages - 1))
        return 1.0 - 2.0 * ((splits[None, :] >> np.arange(languages)[:, None]) & 1)
    rng, best, widest = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(languages)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        same = code @ code.T
        least = int((code.shape[1] - same[~np.eye(languages, dtype=bool)]).min() / 2)
        if least > widest:
            best, widest = code, least
    return best  # type: ignore[return-value]


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the 1-, 2- and 3-byte features that end at each byte, and where each text starts among them."""
    lens = np.array([len(t or b"") for t in texts], np.int64)
    s = np.frombuffer(_GAP.join([b"", *(t or b"" for t in texts)]).translate(CLEAN), np.uint8).astype(np.uint32)
    if not len(texts):
        s = np.zeros(3, np.uint32)
    two = s.copy()
    two[1:] |= s[:-1] << np.uint32(8)
    three = two.copy()
    three[2:] |= s[:-2] << np.uint32(16)
    inside = np.ones(len(s), bool)
    heads = np.concatenate([[0], np.cumsum(lens + len(_GAP))[:-1]]).astype(np.int64) if len(lens) else np.zeros(1, np.int64)
    for k in range(len(_GAP)):
        inside[heads + k] = False
    hashed = (three[inside] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    first = np.concatenate([[0], np.cumsum(lens)])
    return s[inside].astype(np.int64), two[inside].astype(np.int64) + 256, hashed.astype(np.int64) + 256 + (1 << 16), first


def _train_counts(labelled: DataFrame) -> pd.DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows, texts in blocks(batches, BLOCK_BYTES):
            by: dict[str, list] = {}
            for lang, t in zip(rows.column("lang").to_pylist(), texts, strict=True):
                by.setdefault(lang, []).append(t)
            for lang, own in by.items():
                total = sums.setdefault(lang, np.zeros(FEATURES, np.int64))
                for f in features(own)[:3]:
                    total += np.bincount(f, minlength=FEATURES)
        for lang, total in sums.items():
            seen = np.flatnonzero(total)
            for lo in range(0, len(seen), 100_000):
                part = seen[lo : lo + 100_000]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(part), "feature": part.astype(np.int32), "n": total[part]})

    counted = labelled.select("text", "lang").mapInArrow(run, "lang string, feature int, n long")
    return counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()


def _weights(counts: pd.DataFrame, languages: list[str], code: np.ndarray) -> np.ndarray:
    """Log ratio of every feature for every bit (FEATURES x bits)."""
    share = np.zeros((len(languages), FEATURES))
    number = {x: i for i, x in enumerate(languages)}
    share[counts["lang"].map(number).to_numpy(), counts["feature"].to_numpy()] = counts["n"].to_numpy()
    for lo, hi in ((0, 256), (256, 256 + (1 << 16)), (256 + (1 << 16), FEATURES)):
        part = share[:, lo:hi]
        seen = max(1, int((part.sum(axis=0) > 0).sum()))
        share[:, lo:hi] = (part + SMOOTHING) / (part.sum(axis=1, keepdims=True) + SMOOTHING * seen)
    out = np.zeros((FEATURES, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        plus, minus = share[code[:, b] > 0], share[code[:, b] < 0]
        if len(plus) and len(minus):
            out[:, b] = np.log(plus.mean(axis=0)) - np.log(minus.mean(axis=0))
    return out


def margins(texts: list[bytes | None], weights: np.ndarray) -> np.ndarray:
    """Mean log ratio per byte of each text and bit."""
    one, two, three, first = features(texts)
    n = np.diff(first)
    out = np.zeros((len(texts), weights.shape[1]))
    full = np.flatnonzero(n)
    if len(full):
        sums = weights[one]
        sums += weights[two]
        sums += weights[three]
        out[full] = np.add.reduceat(sums, first[:-1][full], axis=0, dtype=np.float64) / n[full, None]
    return out


def fit(labelled: DataFrame) -> dict:
    """Learns from all rows of ``labelled`` (text, lang)."""
    labelled = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    counts = _train_counts(labelled)
    languages = sorted(counts["lang"].unique().tolist())
    code = codebook(len(languages))
    if not languages:
        return {"languages": [], "code": code}
    weights = _weights(counts, languages, code)
    number = {x: i for i, x in enumerate(languages)}
    bits = code.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, size, seen = np.zeros(bits), np.zeros(bits), 0
        for rows, texts in blocks(batches, BLOCK_BYTES):
            want = code[[number[x] for x in rows.column("lang").to_pylist()]]
            m = margins(texts, weights)
            right += (m * want > 0).sum(axis=0)
            size += np.minimum(np.abs(m), 100).sum(axis=0)
            seen += len(texts)
        # margins are summed in millionths, so that the sum doesn't depend on the order of the parts
        yield pa.RecordBatch.from_pydict(
            {"bit": np.arange(bits), "right": right.astype(np.int64), "size": (size * 1e6).astype(np.int64), "seen": np.full(bits, seen)}
        )

    found = labelled.mapInArrow(run, "bit long, right long, size long, seen long").groupBy("bit").agg(
        F.sum("right").alias("right"), F.sum("size").alias("size"), F.sum("seen").alias("seen")
    )
    table = found.toPandas().sort_values("bit")
    seen = np.maximum(table["seen"].to_numpy(), 1)
    accuracy = table["right"].to_numpy() / seen
    trust = np.clip(2 * accuracy - 1, 0.01, 1.0)  # a coin toss counts next to nothing
    scale = 4.0 / np.maximum(table["size"].to_numpy() / 1e6 / seen, 1e-6)  # a usual margin becomes 4
    return {"languages": languages, "code": code, "weights": weights, "trust": trust, "scale": scale, "accuracy": accuracy}


def decode(m: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the nearest language, score 0 to 1, ambiguous) of rows of margins."""
    code, trust = model["code"], model["trust"]
    z = m * model["scale"]
    loss = (np.logaddexp(0.0, -z[:, None, :] * code[None, :, :]) * trust).sum(axis=2)
    best = loss.argmin(axis=1)
    weight = np.exp(loss.min(axis=1, keepdims=True) - loss)
    score = weight.max(axis=1) / weight.sum(axis=1)
    if loss.shape[1] == 1:
        return best, np.ones(len(best)), np.zeros(len(best), bool)
    two = np.partition(loss, 1, axis=1)
    return best, score, (two[:, 1] - two[:, 0]) < MIN_MARGIN * trust.sum() * 4.0


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return any(97 <= b < 123 for b in text.translate(CLEAN)[:64]) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predicted(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with ``lang_pred``, ``score`` and ``ambiguous``."""
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, BLOCK_BYTES):
            langs: list[str] = ["und"] * len(texts)
            score, unsure = np.zeros(len(texts)), np.zeros(len(texts), bool)
            if model["languages"]:
                best, score, unsure = decode(margins(texts, model["weights"]), model)
                some = np.array([has_letter(t) for t in texts], bool)
                langs = [model["languages"][b] if s else "und" for b, s in zip(best.tolist(), some.tolist(), strict=True)]
                score, unsure = np.where(some, score, 0.0), unsure & some
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in keep), pa.array(langs, pa.string()), pa.array(score), pa.array(unsure)],
                names=[*keep, "lang_pred", "score", "ambiguous"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, "lang_pred string, score double, ambiguous boolean"]))


def op1(docs: DataFrame) -> DataFrame:
    """Columns of the contract, one row per document, with ``ambiguous``."""
    held_out = crc_mod("doc_id", 4) == 2
    model = fit(docs.where(~held_out).select("text", "lang"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return predicted(rows, model, keep=["doc_id", "held_out"])
