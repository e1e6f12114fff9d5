"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

Texts are read as *units*: words, with neighbouring single letters taken as one (``i d i o t``). Within a unit letters
are folded to 31 classes (case and accents fall away) and every run of other characters is one gap. The kernel of two
units counts the letter triples both hold as subsequences, each weighted by ``DECAY`` for every place its span exceeds
three, spans up to ``SPAN``; so ``idiot``, ``i.d.i.o.t`` and ``idxiot`` are alike. It is scaled by the roots of the sums of
squared weights of both units, which keeps it a kernel.

Training (labels of documents, sentences inherit them): units with the strongest evidence for toxic documents and units
of clean ones give the landmarks. A unit's Nyström features are its kernel values with the landmarks times the inverse
root of the landmarks' own kernel matrix; a linear machine with squared hinge loss is fitted to them. Which sentence
makes a toxic document toxic isn't labelled, so each round takes the sentence with the highest margin of every toxic
document and the ``HARD`` highest of every clean one, then fits anew. A sentence's margin is that of its highest unit,
a document's that of its highest sentence; a logistic curve with the classes' true shares makes it a score.

The decision function is linear in the kernel, so it collapses exactly to one weight per letter triple (32**3 floats,
128 KB, whatever the corpus): scoring is one narrow pass over whole texts with no shuffle, vectorised over a block.

Fitted on at most ``SAMPLE`` labelled documents a class, those with the least hash of their id; everything that reaches
the driver is bounded by SAMPLE, CANDIDATES and HARD. All other work covers all rows.

Edge cases: a null or empty text, or one without three letters in a unit, has the margin -1; labels without id or value
are ignored, several label rows of an id count as toxic if one says so; if a class has no labelled document, or none that is
in the table, the score is the share of toxic ones among the labelled (0 without any); a null doc_id counts as the empty id text; repeated rows
keep their rows; other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, crc_mod, id_and_text, stored

SAMPLE = 2000  # labelled documents of a class to learn from, at most
CANDIDATES = 3000  # units of a kind that the driver chooses landmarks from, at most
LANDMARKS = 256  # of a kind, at most
ALIKE = 0.9  # landmarks are less alike than this
HARD = 3  # sentences of a clean document in a round
ROUNDS = 3
RIDGE = 1e-4
SPAN, DECAY = 7, 0.6
SLICE_BYTES = 1 << 18
LETTERS = 32  # symbol classes: 0 no letter, 1-26 a-z, 27-31 all others by code point

_PLACES = [(i, j, DECAY ** (j - 2)) for j in range(2, SPAN) for i in range(1, j)]  # of the second and third letter


def fold(code: int) -> int:
    """The symbol of a code point."""
    c = chr(code)
    if not c.isalpha():
        return 0
    base = ord(unicodedata.normalize("NFKD", c.lower())[0])
    return base - 96 if 97 <= base <= 122 else 27 + code % 5


class Units:
    """The units of some texts: symbols with their unit, and where each unit stands in its text (code points)."""

    def __init__(self, texts: list[bytes | None]):
        raw = [(t or b"").decode("utf-8", "replace") for t in texts]
        codes = np.frombuffer("\n".join(raw).encode("utf-32-le", "replace"), np.uint32)
        known, where = np.unique(codes, return_inverse=True)
        symbol = np.array([fold(c) for c in known.tolist()], np.int32)[where]
        blank = np.array([chr(c).isspace() for c in known.tolist()], bool)[where]
        lens = np.array([len(t) for t in raw], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(lens + 1)])
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~blank
        step = np.diff(inside)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        text = np.searchsorted(self.offset, start, "right") - 1
        letters = np.concatenate([[0], np.cumsum(symbol > 0)])
        single = (letters[end] - letters[start] == 1) & (end - start <= 3)
        new = np.ones(len(start), bool)
        new[1:] = ~(single[1:] & single[:-1] & (text[1:] == text[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1 if len(first) else first
        self.text, self.start, self.end = text[first], start[first], end[last]
        # a sentence ends after a unit with a full stop, question or exclamation mark, or before a line break
        stops = np.isin(codes[self.end - 1], [ord(c) for c in ".!?…。！？"]) if len(first) else np.zeros(0, bool)
        lines = np.concatenate([[0], np.cumsum(codes == 10)])
        if len(first):
            stops[:-1] |= lines[self.start[1:]] > lines[self.end[:-1]]
        self.sentence = np.concatenate([[0], np.cumsum(stops[:-1])]) if len(first) else np.zeros(0, np.int64)
        # inside units, a run of other characters is one place
        unit = np.zeros(len(codes) + 1, np.int64)
        unit[self.start] += 1
        unit = np.cumsum(unit)[:-1] - 1
        within = np.zeros(len(codes) + 1, np.int64)
        within[self.start] += 1
        within[self.end] -= 1
        stay = np.cumsum(within)[:-1] > 0
        stay[1:] &= (symbol[1:] > 0) | (symbol[:-1] > 0)
        self.symbol, self.unit = symbol[stay], unit[stay]
        self.first = np.searchsorted(self.unit, np.arange(len(first)))

    def __len__(self) -> int:
        return len(self.text)

    def names(self) -> list[str]:
        """Each unit as a string of symbols, one letter or a gap's dot a place."""
        letters = "".join(map(_SPELLED.__getitem__, self.symbol.tolist()))
        at = [*self.first.tolist(), len(letters)]
        return [letters[lo:hi].strip(".") for lo, hi in zip(at[:-1], at[1:], strict=True)]


_SPELLED = [".", *"abcdefghijklmnopqrstuvwxyz", *"αβγδε"]


def triples(units: Units) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each form of a triple: its weight, the places that have it, and their triple numbers."""
    s, u = units.symbol, units.unit
    n = len(s)
    letter = s > 0
    for i, j, weight in _PLACES:
        if n > j:
            ok = letter[: n - j] & letter[i : n - j + i] & letter[j:] & (u[: n - j] == u[j:])
            at = np.flatnonzero(ok)
            yield weight, at, (s[at] * LETTERS + s[at + i]) * LETTERS + s[at + j]


def sums(units: Units, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit the sum of its weighted triples' rows of ``table``, and the root of its squared weights."""
    out = np.zeros((len(units), *table.shape[1:]), np.float64)
    square = np.zeros(len(units))
    for weight, at, triple in triples(units):
        if not len(at):
            continue
        own = units.unit[at]
        square += weight * weight * np.bincount(own, minlength=len(units))
        if table.ndim == 1:
            out += weight * np.bincount(own, weights=table[triple], minlength=len(units))
        else:
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            out[own[heads]] += weight * np.add.reduceat(table[triple], heads)
    return out, np.sqrt(square)


def margins(units: Units, table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value of each unit; -1 for those without a triple."""
    value, size = sums(units, table)
    return np.where(size > 0, value / np.where(size > 0, size, 1) + bias, -1.0)


class Landmarks:
    """Units as kernel columns, and the map from kernel values to Nyström features."""

    def __init__(self, names: list[str]):
        units = Units([n.replace(".", "-").encode() for n in names])
        self.table = np.zeros((LETTERS**3, len(names)))
        for weight, at, triple in triples(units):
            np.add.at(self.table, (triple, units.unit[at]), weight)
        self.table /= np.maximum(sums(units, np.zeros(LETTERS**3))[1], 1e-12)
        own = self.kernel(names)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        keep = value > 1e-6 * max(value.max(), 1e-12)
        self.root = vector[:, keep] / np.sqrt(value[keep])

    def kernel(self, names: list[str]) -> np.ndarray:
        out = [np.zeros((0, self.table.shape[1]))]
        for lo in range(0, len(names), 500):
            part = names[lo : lo + 500]
            units = Units([n.replace(".", "-").encode() for n in part])
            value, size = sums(units, self.table)
            rows = np.zeros((len(part), self.table.shape[1]))  # an empty name has no unit
            rows[units.text] = value / np.maximum(size, 1e-12)[:, None]
            out.append(rows)
        return np.concatenate(out)

    def features(self, names: list[str]) -> np.ndarray:
        return self.kernel(names) @ self.root

    def collapsed(self, weights: np.ndarray) -> np.ndarray:
        """One weight per letter triple: the decision function of a linear machine over the features."""
        return self.table @ (self.root @ weights)


def chosen(names: list[str], most: int, alike: float = ALIKE) -> list[str]:
    """The first ``most`` of ``names`` that are less alike than ``alike`` to those before them."""
    out: list[str] = []
    held: dict[int, list[tuple[int, float]]] = {}  # triple -> (place, weight) of those taken
    for name in names:
        own: Counter = Counter()
        square = 0.0
        units = Units([name.replace(".", "-").encode()])
        for weight, at, triple in triples(units):
            for t in triple.tolist():
                own[t] += weight
                square += weight * weight
        if not own:
            continue
        near: Counter = Counter()
        for t, weight in own.items():
            for place, w in held.get(t, ()):
                near[place] += weight * w / math.sqrt(square)
        if near and max(near.values()) >= alike:
            continue
        for t, weight in own.items():
            held.setdefault(t, []).append((len(out), weight / math.sqrt(square)))
        out.append(name)
        if len(out) == most:
            break
    return out


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: least sum of weighted squared hinge losses and a ridge, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    keep = np.full(x.shape[1], ridge)
    keep[-1] = ridge * 1e-2
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float((weight * np.maximum(1 - y * (x @ w), 0) ** 2).sum() + (keep * w * w).sum())

    now = loss(w)
    for _ in range(60):
        slack = np.maximum(1 - y * (x @ w), 0)
        active = slack > 0
        slope = -(x[active] * (weight * y * slack)[active, None]).sum(0) + keep * w
        bend = (x[active] * weight[active, None]).T @ x[active] + np.diag(keep)
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now <= 1e-10 * max(before, 1e-12):
            break
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to scores, with Platt's smoothed targets."""
    up, down = toxic.sum(), len(toxic) - toxic.sum()
    target = np.where(toxic == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-6 * a
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        a = a - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 0.0)), float(a[1])


def labelled(labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, toxic): the documents to learn from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).cast("int").alias("toxic"))
    return rows.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out)


def _evidence(sample: DataFrame) -> DataFrame:
    """(unit, up, down): in how many toxic and clean documents of the sample a unit stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, SLICE_BYTES):
            units = Units(texts)
            toxic = rows.column("toxic").to_pylist()
            both: tuple[Counter, Counter] = Counter(), Counter()
            for text, name in {*zip(units.text.tolist(), units.names(), strict=True)}:
                if len(name) >= 3:
                    both[toxic[text]][name] += 1
            names = [*{*both[0], *both[1]}]
            yield pa.RecordBatch.from_pydict(
                {"unit": pa.array(names, pa.string()), "up": pa.array([both[1][n] for n in names], pa.int64()), "down": pa.array([both[0][n] for n in names], pa.int64())}
            )

    return sample.mapInArrow(run, "unit string, up long, down long").groupBy("unit").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))


def _witnesses(sample: DataFrame, table: np.ndarray, bias: float) -> DataFrame:
    """(toxic, margin, unit): the highest unit of the highest sentence of toxic documents, of the HARD highest of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, SLICE_BYTES):
            units = Units(texts)
            value, names = margins(units, table, bias), units.names()
            toxic = rows.column("toxic").to_pylist()
            order = np.lexsort((np.arange(len(value)), -value, units.text))
            taken: dict[int, set] = {}
            out: list[tuple] = []
            for k, text, sentence in zip(order.tolist(), units.text[order].tolist(), units.sentence[order].tolist(), strict=True):
                own = taken.setdefault(text, set())
                if sentence not in own and len(own) < (1 if toxic[text] else HARD):
                    own.add(sentence)
                    out.append((toxic[text], float(value[k]), names[k]))
            for text in range(len(texts)):
                if text not in taken:
                    out.append((toxic[text], -1.0, ""))
            columns = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.string()), strict=True)], names=["toxic", "margin", "unit"])

    return sample.mapInArrow(run, "toxic int, margin double, unit string")


def trained(docs: DataFrame, known: DataFrame, sample_size: int = SAMPLE) -> dict:
    """The machine: ``table`` (weight per triple), ``bias``, and ``slope`` and ``offset`` of the score.

    ``docs``: doc_id and text; ``known``: doc_id and toxic (0 or 1) of the documents to learn from, an id once.
    """
    shares = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    up, down = shares.get(1, 0), shares.get(0, 0)
    offset = -math.inf if not up else math.inf if not down else math.log(up / down)
    flat = {"table": np.zeros(LETTERS**3), "bias": -1.0, "slope": 0.0, "offset": offset}
    if not shares.get(0) or not shares.get(1):
        return flat
    picked = [known.where(f"toxic = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_size) for c in (0, 1)]
    ids = F.broadcast(picked[0].union(picked[1]))  # 2 * sample_size rows at most
    # rows of one id and text count once, so that a repeated id can't fill the sample
    sample = docs.join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = stored(sample.select("toxic", "text"), "labelled")
    counted = stored(_evidence(sample), "evidence")
    seen = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        return flat
    up, down = (F.col("up") + 0.5) / (seen[1] + 1.0), (F.col("down") + 0.5) / (seen[0] + 1.0)
    odds = F.col("up") * F.log(up / down)
    telling = counted.where("up > 0").orderBy(odds.desc(), "unit").limit(CANDIDATES).collect()
    plain = counted.where("down > 0").orderBy(F.xxhash64("unit"), "unit").limit(CANDIDATES).collect()
    telling = [r for r in telling if r.up * seen[0] > r.down * seen[1]]
    landmarks = Landmarks(chosen([r.unit for r in telling], LANDMARKS) + chosen([r.unit for r in plain], LANDMARKS))
    if not landmarks.table.shape[1]:
        return flat
    both = [*telling, *plain]
    x = landmarks.features([r.unit for r in both])
    y = np.repeat([1.0, -1.0], len(both))
    weight = np.concatenate([[r.up / seen[1] for r in both], [r.down / seen[0] for r in both]])
    clean = landmarks.features([r.unit for r in plain])
    w, bias = fitted(np.concatenate([x, x]), y, weight)
    for _ in range(ROUNDS):
        rows = _witnesses(sample, landmarks.collapsed(w), bias).collect()
        toxic = np.array([r.toxic for r in rows])
        x = np.concatenate([landmarks.features([r.unit for r in rows]), clean])
        y = np.concatenate([np.where(toxic == 1, 1.0, -1.0), -np.ones(len(clean))])
        weight = np.concatenate([np.where(toxic == 1, 1 / seen[1], 1 / (HARD * seen[0])), np.full(len(clean), 0.1 / max(len(clean), 1))])
        w, bias = fitted(x, y, weight)
    table = landmarks.collapsed(w)
    best = [(r.toxic, r.margin) for r in _tops(sample, table, bias).collect()]
    toxic, margin = np.array([t for t, _ in best]), np.array([m for _, m in best])
    true = np.where(toxic == 1, shares[1] / seen[1], shares[0] / seen[0]) / (shares[0] + shares[1])
    slope, offset = logistic(margin, toxic, true * len(toxic))
    return {"table": table, "bias": bias, "slope": slope, "offset": offset}


def _tops(sample: DataFrame, table: np.ndarray, bias: float) -> DataFrame:
    """(toxic, margin) of every document of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, SLICE_BYTES):
            margin = highest(texts, table, bias)[0]
            yield pa.RecordBatch.from_arrays([rows.column("toxic").cast(pa.int32()), pa.array(margin)], names=["toxic", "margin"])

    return sample.mapInArrow(run, "toxic int, margin double")


def highest(texts: list[bytes | None], table: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the highest margin and where the first unit that has it begins and ends (-1: no unit)."""
    units = Units(texts)
    value = margins(units, table, bias)
    margin, start, end = np.full(len(texts), -1.0), np.full(len(texts), -1), np.full(len(texts), -1)
    heads = np.flatnonzero(np.append(True, units.text[1:] != units.text[:-1])) if len(units) else np.zeros(0, np.int64)
    if len(heads):
        own = units.text[heads]
        margin[own] = np.maximum.reduceat(value, heads)
        top = np.flatnonzero(value == margin[units.text])
        top = top[np.append(True, units.text[top][1:] != units.text[top][:-1])]
        start[own], end[own] = units.start[top] - units.offset[own], units.end[top] - units.offset[own]
    return margin, start, end


def scored(docs: DataFrame, machine: dict, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (with ``text``), score, margin, and the span (code points) of the highest unit."""
    table, bias = machine["table"].astype(np.float32), machine["bias"]
    slope, offset = machine["slope"], machine["offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, SLICE_BYTES):
            margin, start, end = highest(texts, table, bias)
            score = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -700, 700)))
            if math.isinf(offset):
                score = np.full(len(texts), float(offset > 0))
            columns = [rows.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(score), pa.array(margin), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=[*keep, "score", "margin", "worst_start", "worst_end"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, "score double, margin double, worst_start long, worst_end long"]))


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns of the contract: nothing is learned from documents whose crc32 modulo 5 is 0."""
    held_out = crc_mod("doc_id", 5) == 0
    rows = id_and_text(docs)
    machine = trained(rows, labelled(labels, held_out))
    out = scored(rows.withColumn("held_out", held_out), machine, ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(
        "doc_id", "held_out", "score", "predicted", "worst_start", "worst_end"
    )
