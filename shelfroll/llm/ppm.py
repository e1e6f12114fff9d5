"""Language-model scores by prediction by partial matching (PPM).

A byte-context trie of order ``ORDER`` is trained on the byte streams of the training documents. A document's stream is
a blank, its lower-cased words with a blank after each, and the end symbol; the context of a symbol is the up to
``ORDER`` bytes before it, across blanks, so the order of the words counts. Escapes follow method C (the number of
different symbols seen), and symbols already offered by a longer context are excluded from the shorter ones. Since
every symbol of a context was also seen after its suffix, the excluded set is always the symbols of the longer context,
so each step down needs two numbers per context only and the score is exact PPM-C with exclusion.

A *window* is a context with its symbol. Documents are taken in blocks (``BLOCK_BYTES`` of text), and a block sends its
distinct windows and words once, as sorted, packed arrays:

1. One pass writes, per block: the distinct windows and words with their training counts, and each document's stream
   (compressed).
2. Windows are dealt to parts by the last two bytes of their context, which all longer contexts and all shorter ones
   down to order two share. A pair of bytes with more than ``PART_ROWS`` windows is split by the third; its own table
   of order two (at most 257 entries) is then broadcast with the tables of order one and nought (at most 2**16 + 2**8
   rows). Words are dealt by their hash. A part's blocks are summed in groups of ``GROUP_ROWS`` windows first, then
   the sums of the groups, so that no task sees all blocks of a window that is everywhere.
3. A part holds its piece of the trie in sorted arrays and finds the value of each distinct window by binary search.
   Values (to 32 bits of their mantissa) go back to the groups, and from there to the blocks, in the order the block has
   its windows.
4. Each block makes its documents' windows again and adds up their values, found in a hash table.

Words are identified by a 64-bit hash. Nothing whole passes the driver: only the totals N and V, the weights of the
pairs of bytes (at most 2**16 numbers) and the broadcast tables do.

Edge cases: a null or empty text has the end token alone; with no training text all symbols are equally likely; a null
doc_id counts as the empty id text; repeated ids keep their rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blocks, crc_mod, id_and_text, stored

ORDER = 6
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 20  # text whose windows are made together
SLICE_KEYS = 1 << 20  # keys of a block that are looked at together
MERGE_KEYS = 1 << 19  # keys that wait to be merged into those held, a quarter of what is held at least
CHUNK_BYTES = 1 << 18  # text of the documents in a row of a block
SYMBOLS = 257  # 256 bytes and the end of the text
END = 256
WINDOWS, WORDS, DOCUMENT = 0, 1, 2
PART_ROWS = 2_000_000  # windows, or words, in a part, about
GROUP_ROWS = 20_000_000  # windows of a part, of several blocks, that a task sums

# A window is one number: order (3 bits), context bytes (8 bits each, latest lowest), symbol (9 bits).
_SYMBOL_BITS, _ORDER_SHIFT = 9, 9 + 8 * ORDER


def stream(text: bytes | None) -> tuple[bytes, int]:
    """The bytes of a text's stream before the end symbol, and its words."""
    words = text.translate(LOWER).split() if text else []
    return (b" " + b" ".join(words) + b" ", len(words)) if words else (b" ", 0)


def windows_of(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows of all streams, first window of each and the total): one for each byte but the first, and the end."""
    buf = np.frombuffer(b"".join(streams), np.uint8).astype(np.int64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in streams])])
    n = int(first[-1])
    context = buf.copy()  # of the last bytes, doubled: one, two, four, six
    context[1:] |= buf[:-1] << 8
    four = context.copy()
    four[2:] |= context[:-2] << 16
    four[4:] |= context[:-4] << 32
    key = np.empty(n, np.int64)  # a window for each byte: what comes after it
    key[:-1] = buf[1:]
    key[first[1:] - 1] = END
    key |= four << _SYMBOL_BITS
    key |= ORDER << _ORDER_SHIFT
    # the first ORDER - 1 contexts of a stream are shorter
    for k in range(1, ORDER):
        at = first[:-1] + k - 1
        at = at[at < first[1:]]
        key[at] = (key[at] & ((1 << (8 * k + _SYMBOL_BITS)) - 1)) | (k << _ORDER_SHIFT)
    return key, first


def counted(kept: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of both arrays, sorted, and how often ``kept`` has each."""
    kept = np.sort(kept)
    new = np.flatnonzero(np.append(True, kept[1:] != kept[:-1])) if len(kept) else np.zeros(0, np.int64)
    only = np.unique(other)
    only = only[~_among(kept[new], only)]
    return summed(np.concatenate([kept[new], only]), np.concatenate([np.diff(np.append(new, len(kept))), np.zeros(len(only), np.int64)]))


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are in the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), bool)
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.add.reduceat(counts, new)


class Sums:
    """Keys with counts that come in pieces; pieces are merged when they have grown a quarter as large as what is merged.

    Known keys are counted in place and new ones are put in between, so that a merge holds little beside the result."""

    def __init__(self):
        self.keys, self.counts, self.pieces, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.pieces.append((keys, counts))
        self.size += len(keys)
        if self.size > max(len(self.keys) // 4, MERGE_KEYS):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.pieces:
            every = [[k for k, _ in self.pieces], [c for _, c in self.pieces]]
            self.pieces, self.size = [], 0
            counts, keys = np.concatenate(every.pop()), np.concatenate(every.pop())  # each array goes as soon as the next is made
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            counts = counts[order]
            del order
            new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            counts = np.add.reduceat(counts, new) if len(new) else counts
            keys = keys[new]
            del new
            if not len(self.keys):
                self.keys, self.counts = keys, counts
                return self.keys, self.counts
            at = np.searchsorted(self.keys, keys)
            known = _among(self.keys, keys)
            self.counts[at[known]] += counts[known]
            at, keys, counts = at[~known], keys[~known], counts[~known]
            if len(keys):
                self.counts = np.insert(self.counts, at, counts)
                self.keys = np.insert(self.keys, at, keys)
        return self.keys, self.counts

    def drain(self) -> tuple[np.ndarray, np.ndarray]:
        """What is merged; nothing is held after it."""
        out, self.keys, self.counts = self.merge(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


class Table:
    """Values of distinct numbers: a hash table with open addressing, filled and read in whole arrays. A slot holds the
    place of its key, so that keys and values stay in the arrays they came in."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(1.4 * len(keys)).bit_length())
        self.keys, self.values = keys, values
        self.places = np.full(1 << self.bits, -1, np.int32 if len(keys) < 1 << 31 else np.int64)
        for lo in range(0, len(keys), 1 << 18):
            self._fill(np.arange(lo, min(lo + (1 << 18), len(keys)), dtype=self.places.dtype))

    def _fill(self, place: np.ndarray) -> None:
        slot = self._slot(self.keys[place])
        while len(place):
            free = self.places[slot] == -1
            self.places[slot[free]] = place[free]  # of several keys for a slot the last one stays
            other = self.places[slot] != place
            place, slot = place[other], (slot[other] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``, all of which are in the table."""
        slot = self._slot(keys)
        place = self.places[slot]
        missed = np.flatnonzero(self.keys[place] != keys)
        while len(missed):
            slot[missed] = (slot[missed] + 1) & ((1 << self.bits) - 1)
            place[missed] = self.places[slot[missed]]
            missed = missed[self.keys[place[missed]] != keys[missed]]
        return self.values[place]


def sliced(streams: list[bytes]) -> Iterator[list[bytes]]:
    """The streams in slices of at most SLICE_BYTES, one stream at least."""
    lo = 0
    while lo < len(streams):
        hi, size = lo, 0
        while hi < len(streams) and (hi == lo or size + len(streams[hi]) <= SLICE_BYTES):
            size += len(streams[hi])
            hi += 1
        yield streams[lo:hi]
        lo = hi


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1


def _pack(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(numbers).data)


def _unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack_values(values: np.ndarray) -> bytes:
    """Doubles to 32 bits of their mantissa, byte by byte: like bytes stand together and the last ones are nought."""
    bits = (values.view(np.int64) + (1 << 19)) & ~((1 << 20) - 1)
    return _pack(np.ascontiguousarray(bits.view(np.uint8).reshape(-1, 8).T))


def _unpack_values(data: bytes) -> np.ndarray:
    planes = _unpack(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.float64).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data))


FOUND = pa.schema(
    [
        ("block", pa.int64()), ("kind", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("payload", pa.binary()), ("counts", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    ]
)
FOUND_SCHEMA = (
    "block long, kind int, place int, n long, payload binary, counts binary, doc_ids array<bigint>, words array<bigint>, held_out array<boolean>"
)


def _give_back() -> None:
    """What this process has freed goes back to the machine: an idle Python worker would hold its largest block's memory."""
    pa.system_memory_pool().release_unused()


def _each(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The rows of a batch, one after the other: its packed arrays are not copied all at once."""
    own = [batch.column(c) for c in columns]
    for i in range(batch.num_rows):
        yield tuple(x[i].as_py() for x in own)


def _rows(schema: pa.Schema, m: int, **columns) -> pa.RecordBatch:
    """``m`` rows; a column that isn't given is null, a single number stands for all rows."""
    arrays = []
    for f in schema:
        own = columns.get(f.name)
        arrays.append(pa.nulls(m, f.type) if own is None else pa.array(np.full(m, own) if isinstance(own, int) else own, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _collect(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of all blocks: WINDOWS and WORDS have the block's distinct keys (``n`` of them) with their training counts,
    a DOCUMENT row has the streams of some documents, their ids and numbers of words. ``place`` orders a block's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
        pack = zstandard.ZstdCompressor(level=3).compress
        partition, number = TaskContext.get().partitionId(), 0

        def close(windows: Sums, words: Sums) -> Iterator[pa.RecordBatch]:
            for kind, held in ((WINDOWS, windows), (WORDS, words)):
                keys, counts = held.drain()
                yield _rows(FOUND, 1, block=partition << 32 | number, kind=kind, place=kind, n=len(keys), payload=[_pack_sorted(keys)], counts=[_pack(counts)])
            del keys, counts
            _give_back()

        windows, words, size = Sums(), Sums(), 0
        for batch, texts in blocks(batches, min(CHUNK_BYTES, block_bytes)):
            mine = sum([len(t or b"") for t in texts])
            if size and size + mine > block_bytes:
                yield from close(windows, words)
                windows, words, size, number = Sums(), Sums(), 0, number + 1
            held_out = [bool(h) for h in batch.column("held_out").to_pylist()]
            streams, counts = zip(*map(stream, texts), strict=True)
            seen: Counter = Counter()  # words themselves are kept for these documents only
            for out in (False, True):  # documents to learn from, then the others
                own = [x for x, h in zip(streams, held_out, strict=True) if h == out]
                for some in sliced(own):
                    keys = windows_of(some)[0]
                    windows.add(*counted(*((keys[:0], keys) if out else (keys, keys[:0]))))
                for x in own:
                    seen.update(dict.fromkeys(x.split(), 0) if out else x.split())
            words.add(np.fromiter(map(word_key, seen), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen)))
            size += max(mine, 1)
            yield _rows(
                FOUND, 1, block=partition << 32 | number, kind=DOCUMENT, place=1 << 30, payload=[pack(b"\n".join(streams))],
                doc_ids=[batch.column("doc_id").to_pylist()], words=[list(counts)], held_out=[held_out],
            )
        if size:
            yield from close(windows, words)

    return docs.mapInArrow(run, FOUND_SCHEMA)


class Trie:
    """Counts of windows, shorter orders made from the longest; all arrays sorted by window."""

    def __init__(self, key: np.ndarray, n: np.ndarray, least: int, below: Trie | None = None):
        """``key``: windows of any order with training counts; orders from ``least`` up are built, ``below`` has the rest."""
        order = key >> _ORDER_SHIFT
        self.levels: dict[int, dict] = {}
        self.least, self.below = least, below
        above = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for k in range(ORDER, least - 1, -1):
            own = (order == k) & (n > 0)
            body = np.concatenate([key[own] & ((1 << _ORDER_SHIFT) - 1), above[0]])
            self.levels[k] = level = _level(body, np.concatenate([n[own], above[1]]))
            symbol = level["key"] & ((1 << _SYMBOL_BITS) - 1)
            context = level["key"] >> _SYMBOL_BITS & ((1 << (8 * (k - 1))) - 1) if k else level["key"] * 0
            above = (context << _SYMBOL_BITS | symbol, level["n"])
        self.rest = above  # the windows of order least - 1 that follow from these
        for k in sorted(self.levels):
            level = self.levels[k]
            lower = self.level(k - 1) if k else None
            if lower is None:
                continue
            # the part of the suffix context's symbols that this context offers itself
            symbol = level["key"] & ((1 << _SYMBOL_BITS) - 1)
            context = level["key"] >> _SYMBOL_BITS
            shorter = (context & ((1 << (8 * (k - 1))) - 1)) if k > 1 else context * 0
            at = np.searchsorted(lower["key"], shorter << _SYMBOL_BITS | symbol)
            level["covered"] = np.add.reduceat(lower["n"][at], level["start"]) if len(at) else np.zeros(0, np.int64)

    def level(self, k: int) -> dict | None:
        if k in self.levels:
            return self.levels[k]
        return self.below.level(k) if self.below is not None and k >= 0 else None

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each window."""
        out = np.zeros(len(key))
        live = np.arange(len(key))
        order = key >> _ORDER_SHIFT
        symbol = key & ((1 << _SYMBOL_BITS) - 1)
        context = (key & ((1 << _ORDER_SHIFT) - 1)) >> _SYMBOL_BITS
        excluded = np.zeros(len(key), np.int64)  # counts and symbols excluded at the present order
        gone = np.zeros(len(key), np.int64)
        for k in range(ORDER, -1, -1):
            at = live[order[live] >= k]
            level = self.level(k)
            if not len(at) or level is None or not len(level["context"]):
                continue
            own = context[at] & ((1 << (8 * k)) - 1)
            c = np.minimum(np.searchsorted(level["context"], own), len(level["context"]) - 1)
            seen = level["context"][c] == own
            at, c, own = at[seen], c[seen], own[seen]
            if not len(at):
                continue
            whole = level["total"][c] - excluded[at]
            kinds = level["kinds"][c] - gone[at]
            base = np.maximum(whole + kinds, 1)
            want = own << _SYMBOL_BITS | symbol[at]
            e = np.minimum(np.searchsorted(level["key"], want), len(level["key"]) - 1)
            hit = level["key"][e] == want
            out[at[hit]] += np.log10(level["n"][e[hit]] / base[hit])
            miss = ~hit
            # all remaining symbols excluded: the escape is certain
            out[at[miss]] += np.log10(np.where(kinds[miss] > 0, kinds[miss], 1) / np.where(kinds[miss] > 0, base[miss], 1))
            gone[at[miss]] = level["kinds"][c[miss]]
            excluded[at[miss]] = level["covered"][c[miss]] if k else 0
            done = np.zeros(len(key), bool)
            done[at[hit]] = True
            live = live[~done[live]]
        out[live] -= np.log10(np.maximum(SYMBOLS - gone[live], 1))  # order -1: symbols never seen, equally likely
        return out


def _level(key: np.ndarray, n: np.ndarray) -> dict:
    if len(key):
        key, where = np.unique(key, return_inverse=True)
        n = np.bincount(where, weights=n).astype(np.int64)
    context, start = np.unique(key >> _SYMBOL_BITS, return_index=True)
    kinds = np.diff(np.append(start, len(key)))
    total = np.add.reduceat(n, start) if len(key) else np.zeros(0, np.int64)
    return {"key": key, "n": n, "context": context, "start": start, "kinds": kinds, "total": total, "covered": np.zeros(len(start), np.int64)}


def _pairs(found: DataFrame) -> DataFrame:
    """(pair, symbol, n, refs): training count and windows of all blocks by the last two bytes of the context and the
    symbol; pairs of windows of order one are -1 less their byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
        for batch in batches:
            for payload, counts in _each(batch, "payload", "counts"):
                keys, n = _unpack_sorted(payload), _unpack(counts)
                trained, refs = Sums(), Sums()
                for lo in range(0, len(keys), SLICE_KEYS):
                    some = keys[lo : lo + SLICE_KEYS]
                    context = some >> _SYMBOL_BITS
                    both = np.where(some >> _ORDER_SHIFT >= 2, context & 0xFFFF, -1 - (context & 255)) * 512 + (some & 511)
                    trained.add(*summed(both, n[lo : lo + SLICE_KEYS]))
                    refs.add(*summed(both, np.ones(len(both), np.int64)))
                both, n = trained.merge()
                yield pa.RecordBatch.from_pydict(
                    {"pair": pa.array(both >> 9), "symbol": pa.array(both & 511), "n": pa.array(n), "refs": pa.array(refs.merge()[1])}
                )
                del keys, n, payload, counts
                _give_back()

    found = found.where(f"kind = {WINDOWS}").select("payload", "counts").mapInArrow(run, "pair long, symbol long, n long, refs long")
    return found.groupBy("pair", "symbol").agg(F.sum("n").alias("n"), F.sum("refs").alias("refs"))


class Deal:
    """Which part each window and word belongs to."""

    def __init__(self, refs: dict[int, int], word_refs: int, part_rows: int):
        self.of_pair = np.zeros(1 << 16, np.int32)
        self.pieces = np.ones(1 << 16, np.int32)
        load: list[int] = [0]
        self.hot = sorted(p for p, n in refs.items() if p >= 0 and n > part_rows)
        for p, n in sorted(refs.items()):
            if p >= 0 and n <= part_rows:
                if load[-1] and load[-1] + n > part_rows:
                    load.append(0)
                self.of_pair[p] = len(load) - 1
                load[-1] += n
        self.low = len(load)  # parts below this have whole pairs, those up to ``words`` have pieces of hot pairs
        at = self.low
        for p in self.hot:
            self.of_pair[p], self.pieces[p] = at, min(256, math.ceil(refs[p] / part_rows))
            at += int(self.pieces[p])
            load += [math.ceil(refs[p] / int(self.pieces[p]))] * int(self.pieces[p])
        self.words = at
        self.word_parts = max(1, math.ceil(word_refs / part_rows))
        self.load = load + [math.ceil(word_refs / self.word_parts)] * self.word_parts

    def windows(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty(len(keys), np.int32)
        for lo in range(0, len(keys), SLICE_KEYS):
            out[lo : lo + SLICE_KEYS] = self._windows(keys[lo : lo + SLICE_KEYS])
        return out

    def _windows(self, keys: np.ndarray) -> np.ndarray:
        context, order = keys >> _SYMBOL_BITS, keys >> _ORDER_SHIFT
        pair = np.where(order >= 2, context & 0xFFFF, 0)
        third = np.where(order >= 3, context >> 16 & 255, 0)
        part = self.of_pair[pair] + (third * 2654435761 >> 7) % self.pieces[pair]
        return np.where(order >= 2, part, 0)  # shorter ones need the broadcast tables only

    def word_part(self, keys: np.ndarray) -> np.ndarray:
        return (self.words + (keys >> 40) % self.word_parts).astype(np.int32)

    def cut(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
        """(order of the keys by part, the parts they have, where each begins in that order, and the end)."""
        part = self.windows(keys) if kind == WINDOWS else self.word_part(keys)
        sizes = np.bincount(part, minlength=1)
        own = np.flatnonzero(sizes)
        # numbers of 16 bits are sorted by their digits
        order = np.argsort(part.astype(np.uint16) if len(sizes) <= 1 << 16 else part, kind="stable")
        return order, own.tolist(), [0, *np.cumsum(sizes[own]).tolist()]


PIECE = pa.schema([("part", pa.int32()), ("grp", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
PIECE_SCHEMA = "part int, grp int, block long, keys binary, counts binary"


def _pieces(found: DataFrame, deal: Deal, group_rows: int) -> DataFrame:
    """The keys of every block cut by part, in their order; blocks of a part form groups of about ``group_rows`` keys."""
    groups = np.maximum(1, np.ceil(np.array(deal.load) / group_rows)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
        for batch in batches:
            for block, kind, payload, counts in _each(batch, "block", "kind", "payload", "counts"):
                keys, n = _unpack_sorted(payload), _unpack(counts)
                if not len(keys):
                    continue
                order, parts, cuts = deal.cut(kind, keys)
                for first in range(0, len(parts), 64):
                    own = np.array(parts[first : first + 64])
                    at = [order[cuts[i] : cuts[i + 1]] for i in range(first, first + len(own))]
                    group = (block * 0x9E3779B1 >> 7) % groups[own]
                    yield _rows(PIECE, len(own), part=own, grp=group, block=block, keys=[_pack_sorted(keys[x]) for x in at], counts=[_pack(n[x]) for x in at])
                del keys, n, order, at, payload, counts
                _give_back()

    rows = found.where(f"kind IN ({WINDOWS}, {WORDS})").select("block", "kind", "payload", "counts")
    return rows.mapInArrow(run, PIECE_SCHEMA)


def _summed(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(part, group, keys, counts), summed by ``by``, of pieces in that order; a group that isn't in ``by`` is nought."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
    at, held = None, Sums()
    for batch in batches:
        for part, grp, keys, counts in _each(batch, "part", "grp", "keys", "counts"):
            now = (part, grp if "grp" in by else 0)
            if now != at:
                if at is not None:
                    yield *at, *held.drain()
                at, held = now, Sums()
            held.add(_unpack_sorted(keys), _unpack(counts))
    if at is not None:
        yield *at, *held.drain()


def _sums(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Keys and counts summed by ``by``; ``block`` is nought."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, grp, keys, n in _summed(batches, by):
            yield _rows(PIECE, 1, part=part, grp=grp, block=0, keys=[_pack_sorted(keys)], counts=[_pack(n)])
            keys = n = None
            _give_back()

    return pieces.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, PIECE_SCHEMA)


def _values(pieces: DataFrame, deal: Deal, tables: np.ndarray) -> DataFrame:
    """(part, keys, values, n, v) of the sums of ``pieces``: the log10 probability of each window, the count of each word;
    the sum of the counts and the number of keys with one. ``tables``: rows (key, n) of the shared tables of low order.

    Summing and looking up are one pass: a task with two passes would keep two Python workers, and their memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = Trie(tables[:, 0], tables[:, 1], 0)
        for part, _, keys, n in _summed(batches, ["part"]):
            if part < deal.words:
                trie = Trie(keys, n, 2 if part < deal.low else 3, below)
                found = np.concatenate([np.zeros(0), *(trie.log10(keys[lo : lo + 200_000]) for lo in range(0, len(keys), 200_000))])
            else:
                found = n.astype(np.float64)
            trie = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([_pack_sorted(keys)], pa.binary()), pa.array([_pack_values(found)], pa.binary()), pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])],
                names=["part", "keys", "values", "n", "v"],
            )
            keys = n = found = None
            _give_back()

    dealt = pieces.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "part int, keys binary, values binary, n long, v long")


def _returned(pieces: DataFrame, values: DataFrame) -> DataFrame:
    """Rows of FOUND for every piece: its values, in the order of its keys; ``place`` is 2 and the part."""
    groups = pieces.select("part", "grp").distinct()
    own = values.join(groups, "part").select("part", "grp", F.lit(-1).cast("long").alias("block"), "keys", F.col("values").alias("counts"))
    both = own.union(pieces.select("part", "grp", "block", "keys", F.lit(None).cast("binary").alias("counts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = found = np.zeros(0)
        for batch in batches:
            for part, block, packed, data in _each(batch, "part", "block", "keys", "counts"):
                if block < 0:
                    keys, found = _unpack_sorted(packed), _unpack_values(data)
                else:
                    out = found[np.searchsorted(keys, _unpack_sorted(packed))]
                    yield _rows(FOUND, 1, block=block, kind=3, place=2 + part, n=len(out), payload=[_pack_values(out)])
        keys = found = out = None
        _give_back()

    return both.repartition("part", "grp").sortWithinPartitions("part", "grp", "block").mapInArrow(run, FOUND_SCHEMA)


def scores(docs: DataFrame, held_out, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``held_out``: a boolean column; documents where it is true are scored, but nothing is learned from them.
    """
    rows = id_and_text(docs, held_out.alias("held_out"))
    found = stored(_collect(rows, block_bytes), "blocks")
    pairs = stored(_pairs(found), "pairs")
    refs = {r.pair: r.refs for r in pairs.groupBy("pair").agg(F.sum("refs").alias("refs")).collect()}  # 2**16 + 2**8 at most
    word_refs = found.where(f"kind = {WORDS}").agg(F.sum("n")).first()[0] or 0
    deal = Deal(refs, word_refs, PART_ROWS)
    # order two of hot pairs, order one of all other windows
    hot = F.col("pair").isin(deal.hot) if deal.hot else F.lit(False)
    byte = F.when(F.col("pair") < 0, -1 - F.col("pair")).otherwise(F.col("pair").bitwiseAND(255))
    low = pairs.where("n > 0").groupBy(hot.alias("hot"), F.when(hot, F.col("pair")).otherwise(byte).alias("context"), "symbol").agg(F.sum("n").alias("n")).collect()
    tables = np.array([((2 if r.hot else 1) << _ORDER_SHIFT | r.context << _SYMBOL_BITS | r.symbol, r.n) for r in low], np.int64).reshape(-1, 2)
    pieces = _pieces(found, deal, GROUP_ROWS)
    values = stored(_values(_sums(pieces, ["part", "grp"]), deal, tables), "values")
    total = values.where(F.col("part") >= deal.words).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    ends = rows.where(~F.col("held_out")).count()
    n_train = int(total.n or 0) + ends
    v_train = int(total.v or 0) + (ends > 0)
    below = n_train + 0.1 * (v_train + 1)
    end_base = math.log10((ends + 0.1) / below)
    every = found.withColumn("counts", F.lit(None).cast("binary")).union(_returned(pieces, values).select(*found.columns))
    n_blocks = found.where(f"kind = {WORDS}").count()
    every = every.repartition(max(1, 2 * n_blocks), "block").sortWithinPartitions("block", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
        unpack = zstandard.ZstdDecompressor().decompress
        block, held = None, {}

        def prepare() -> None:
            """The windows' and the words' values, in tables."""
            for kind in (WINDOWS, WORDS):
                keys = held.pop(kind)
                order, parts, cuts = deal.cut(kind, keys)
                found = np.zeros(len(keys))
                for p, lo, hi in zip(parts, cuts[:-1], cuts[1:], strict=True):
                    found[order[lo:hi]] = held["values"].pop(p)
                del order
                held["gain" if kind == WINDOWS else "count"] = Table(keys, found)

        for batch in batches:
            for i, (b, kind, place) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "place")), strict=True)):
                if b != block:
                    block, held = b, {"values": {}, WINDOWS: np.zeros(0, np.int64), WORDS: np.zeros(0, np.int64), "ready": False}
                payload = batch.column("payload")[i].as_py()
                if kind in (WINDOWS, WORDS):
                    held[kind] = _unpack_sorted(payload)
                elif kind != DOCUMENT:
                    held["values"][place - 2] = _unpack_values(payload)
                else:
                    if not held["ready"]:
                        prepare()
                        held["ready"] = True
                        _give_back()
                    yield score(batch.slice(i, 1), unpack(payload).split(b"\n"), held)
        held = None
        _give_back()

    def score(row: pa.RecordBatch, streams: list[bytes], held: dict) -> pa.RecordBatch:
        gains, bases, known = [], [], []
        for some in sliced(streams):
            keys, first = windows_of(some)
            gains.append(np.add.reduceat(held["gain"].of(keys), first[:-1]))
            words = [x.split() for x in some]
            number = dict.fromkeys(w for own in words for w in own)
            counts = held["count"].of(np.fromiter(map(word_key, number), np.int64, len(number)))
            count_of = dict(zip(number, counts.tolist(), strict=True))
            for own in words:
                c = np.fromiter(map(count_of.__getitem__, own), np.float64, len(own))
                bases.append(float(np.log10((c + 0.1) / below).sum()) + end_base)
                known.append(int((c > 0).sum()) + (ends > 0))
        doc_ids, words, held_out = (row.column(c).flatten() for c in ("doc_ids", "words", "held_out"))
        n = words.to_numpy() + 1
        return pa.RecordBatch.from_arrays(
            [
                doc_ids, held_out, pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), n_train, np.int64)),
                pa.array(bases, pa.float64()), pa.array(np.concatenate(gains), pa.float64()),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return every.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op10(docs: DataFrame) -> DataFrame:
    """Columns of the contract: documents whose crc32 modulo 10 is 0 are held out."""
    return scores(docs, crc_mod("doc_id", 10) == 0)
