"""Alignment of two tokenizers' tokens by lockstep merging, and how often their ids go together.

Every text is encoded by a byte-level BPE (A) and a piece model with byte fallback (B); both cover the same bytes, a blank
and the text. A block of documents is aligned at once: one state vector holds the A and the B pointer of every lane, a
step compares the byte ends under all pointers, emits a link and a cut for each lane whose ends are equal, advances the
pointer that is behind (both at a link), and drops finished lanes from the vector. A lane is a document, or a piece of a
long one: where every ``LANE``-th A token ends, binary search in the ends of B tells whether a B token ends there too,
and if so a new lane starts. So the number of steps doesn't follow the longest document.

How often an id pair is linked is a count over all documents:

1. One pass over the documents writes, per block of ``BLOCK_BYTES`` of text, the block's distinct id pairs with their
   links, and per document its numbers and a compressed list of (pair number, links).
2. Pairs are summed over all blocks. The highest count of each B id comes from the sums; that table has a row per B id
   at most (``n_b_ids``, 32,000 for the given model), so it may be broadcast.
3. The sums return to the blocks by one join on the pair, where a pair has at most one row a block, and every document
   adds up its own links.

Nothing of a size that grows with the documents passes the driver.

Edge cases: a null or empty text has no tokens, nor has one whose bytes a tokenizer changes (U+2581 in a text becomes a
blank); strings of special tokens are plain text; a null doc_id stays; repeated rows count each; other columns are not
read; no documents give no rows. Every token has a byte at least (checked when the files are loaded), so ends are
strictly increasing and each cut has one link.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import blocks, id_and_text, stored, worker_cache

BLOCK_BYTES = 16 << 20  # text whose pairs are counted together before they are sent
SLICE_BYTES = 1 << 20  # text that is encoded and aligned at a time
LANE = 96  # A tokens after which a lane may end
LONG_RUN = 1000  # bytes without a change of kind beyond which the JSON tokenizer, whose merges are n log n, takes a text
PAIR, DOCUMENT = 0, 1
_B_BITS = 32

#: The pattern that cuts text into pieces of byte-level BPE, and letters that every version of Unicode
#: since 5.0 classes alike.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SETTLED = r"\x00-\x7fÀ-ÖØ-öø-ɏ"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteTokens:
    """Byte-level BPE of a tokenizer file. Where the file's merges are in the order of the ids they make, a rank
    encoder built from them gives the same ids faster; texts with letters whose class depends on the Unicode version,
    and those with very long pieces, go through the file's own tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        back = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = token.encode() if token in special else bytes(back[c] for c in token)
        if any(not b for b in self.bytes_of):
            raise ValueError(f"{path} has tokens without bytes")
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        self.ranked = None
        if made == sorted(made):
            import tiktoken

            ranks = {self.bytes_of[i]: i for t, i in vocab.items() if t not in special}
            self.ranked = tiktoken.Encoding("byte-bpe", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile(f"[^{SETTLED}]").search
        kind = np.full(256, 1, np.uint8)  # letters, digits and bytes of longer characters
        kind[[b for b in range(128) if not chr(b).isalnum()]] = 2
        kind[list(b"\t\n\v\f\r ")] = 3
        self.kind = kind

    def encode(self, text: str, raw: bytes) -> list[int]:
        """Ids of ``text``, whose UTF-8 form is ``raw``."""
        if self.ranked is not None and (len(raw) == len(text) or not self.other(text)):
            kind = self.kind[np.frombuffer(raw, np.uint8)]
            turns = np.flatnonzero(kind[1:] != kind[:-1])
            if len(raw) <= LONG_RUN or np.diff(turns, prepend=-1, append=len(raw) - 1).max() <= LONG_RUN:
                return self.ranked.encode_ordinary(text)
        return self.own.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Tokens of a piece model: U+2581 stands for a blank, <0xHH> for a byte."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.own
        self.bytes_of = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]
        if any(not b for b in self.bytes_of):
            raise ValueError(f"{path} has pieces without bytes")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1) if texts else []


class Tokenizers:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        # decimal ids with what follows them in the digest: a comma inside a group, else a bar (A) or a semicolon (B)
        self.width = max(len(self.size_a), len(self.size_b))
        self.written = [f"{i}{after}" for after in ",|,;" for i in range(self.width)]


class Aligned:
    """Tokens of some texts and the cuts between their groups, all in flat arrays; ``valid`` texts have tokens."""

    def __init__(self, texts: list[bytes | None], tok: Tokenizers):
        plain = [(i, raw, raw.decode("utf-8", "replace")) for i, raw in enumerate(texts) if raw]
        ids_b = tok.b.encode([t for _, _, t in plain])
        of_a, of_b = tok.a.bytes_of.__getitem__, tok.b.bytes_of.__getitem__
        self.valid, lists_a, lists_b = [], [], []
        for (i, raw, text), b in zip(plain, ids_b, strict=True):
            whole = b" " + raw
            a = tok.a.encode(" " + text, whole)
            if b"".join(map(of_a, a)) == whole and b"".join(map(of_b, b)) == whole:
                self.valid.append(i)
                lists_a.append(a)
                lists_b.append(b)
        self.first_a, self.a = _flat(lists_a)
        self.first_b, self.b = _flat(lists_b)
        # byte ends counted through all texts, so they increase and ends of different texts never meet
        self.end_a, self.end_b = np.cumsum(tok.size_a[self.a]), np.cumsum(tok.size_b[self.b])
        self.link_a, self.link_b = lockstep(self.end_a, self.end_b, *lanes(self.end_a, self.end_b, self.first_a, self.first_b))
        self.first_link = np.searchsorted(self.link_a, self.first_a)

    def written(self, tok: Tokenizers) -> list[str]:
        """The groups of each valid text as decimal ids."""
        n_a, n_b = len(self.a), len(self.b)
        # an A token stands behind all B tokens of the groups before its own, a B token behind all A tokens up to its own
        group_a = np.searchsorted(self.link_a, np.arange(n_a))
        group_b = np.searchsorted(self.link_b, np.arange(n_b))
        start_b = np.concatenate([[0], self.link_b[:-1] + 1]) if len(self.link_b) else np.zeros(0, np.int64)
        keys = np.empty(n_a + n_b, np.int64)
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[self.link_a], last_b[self.link_b] = True, True
        keys[np.arange(n_a) + start_b[group_a]] = self.a + np.where(last_a, tok.width, 0)
        keys[np.arange(n_b) + self.link_a[group_b] + 1] = self.b + np.where(last_b, 3, 2) * tok.width
        parts, at = [*map(tok.written.__getitem__, keys.tolist())], (self.first_a + self.first_b).tolist()
        return ["".join(parts[lo:hi])[:-1] for lo, hi in zip(at[:-1], at[1:], strict=True)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.cumsum([0] + [len(x) for x in lists])
    out = np.empty(first[-1], np.int64)
    for lo, hi, x in zip(first[:-1], first[1:], lists, strict=True):
        out[lo:hi] = x
    return first, out


def lanes(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A start, B start, A end) of each lane: the documents, cut where every ``lane``-th A token ends with a B token."""
    at = np.arange(len(end_a))
    tried = at[(at - np.repeat(first_a[:-1], np.diff(first_a))) % lane == lane - 1]
    found = np.minimum(np.searchsorted(end_b, end_a[tried]), max(len(end_b) - 1, 0))
    common = end_b[found] == end_a[tried]
    start_a = np.concatenate([first_a[:-1], tried[common] + 1])
    start_b = np.concatenate([first_b[:-1], found[common] + 1])
    start_a, where = np.unique(start_a, return_index=True)
    stay = start_a < len(end_a)
    start_a, start_b = start_a[stay], start_b[where][stay]
    return start_a, start_b, np.append(start_a[1:], len(end_a))


def lockstep(end_a: np.ndarray, end_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A and B tokens that end together, in order; every lane's last tokens do."""
    a, b, stop = start_a.copy(), start_b.copy(), stop_a
    links_a, links_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(a):
        ends_a, ends_b = end_a[a], end_b[b]
        same = ends_a == ends_b
        links_a.append(a[same])
        links_b.append(b[same])
        a += ends_a <= ends_b
        b += ends_b <= ends_a
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    link_a, link_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(link_a, kind="stable")
    return link_a[order], link_b[order]


def _loaded(paths: tuple[str, str]) -> Tokenizers:
    return worker_cache("aligned" + "|".join(paths), lambda: Tokenizers(*paths))  # type: ignore[return-value]


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, links (array of A and B positions that end together) and cuts (their byte offsets in the
    blank and the text) of every row of ``docs``."""
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(paths)
        for rows, texts in blocks(batches, SLICE_BYTES):
            out = Aligned(texts, tok)
            ids_a, ids_b, links, cuts = ([[] for _ in texts] for _ in range(4))
            for n, i in enumerate(out.valid):
                (la, ha), (lb, hb) = out.first_a[n : n + 2].tolist(), out.first_b[n : n + 2].tolist()
                own = slice(*out.first_link[n : n + 2].tolist())
                base = int(out.end_a[la - 1]) if la else 0
                ids_a[i], ids_b[i] = out.a[la:ha].tolist(), out.b[lb:hb].tolist()
                links[i] = [{"a": x, "b": y} for x, y in zip((out.link_a[own] - la).tolist(), (out.link_b[own] - lb).tolist(), strict=True)]
                cuts[i] = (out.end_a[out.link_a[own]] - base).tolist()
            kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip((ids_a, ids_b, links, cuts), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=["doc_id", "a_ids", "b_ids", "links", "cuts"])

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, links array<struct<a int, b int>>, cuts array<bigint>"
    )


FOUND = pa.schema(
    [
        ("block", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("payload", pa.binary()),
    ]
)


def _found(**columns) -> pa.RecordBatch:
    """Rows of FOUND; a column that isn't given is null, a single number stands for all rows."""
    m = len(columns["key"])
    arrays = []
    for f in FOUND:
        own = columns.get(f.name)
        if own is None:
            arrays.append(pa.nulls(m, f.type))
        else:
            arrays.append(pa.array(np.full(m, own) if isinstance(own, int) else own, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=FOUND)


def _collect(docs: DataFrame, paths: tuple[str, str], block_bytes: int) -> DataFrame:
    """Rows of all blocks: a PAIR row has the links of an id pair in the block, a DOCUMENT row the document's numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(paths)
        pack = zstandard.ZstdCompressor(level=1).compress
        partition, number = TaskContext.get().partitionId(), 0

        def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            block = partition << 32 | number
            number += 1
            own = np.concatenate([own for own, _, _ in held])
            pairs, where = np.unique(own, return_inverse=True)
            links = np.bincount(where, weights=np.concatenate([count for _, count, _ in held]), minlength=len(pairs))
            for lo in range(0, len(pairs), 100_000):
                part = slice(lo, lo + 100_000)
                yield _found(block=block, kind=PAIR, key=pairs[part], n=links[part].astype(np.int64))
            at = 0
            for own, count, rows in held:
                places, counts = where[at : at + len(own)].astype(np.uint32), count.astype(np.uint32)
                at += len(own)
                stops = rows.pop("stops")
                payload = [
                    pack(np.concatenate([np.diff(places[lo:hi], prepend=np.uint32(0)), counts[lo:hi]]).tobytes()) if hi > lo else None
                    for lo, hi in zip([0, *stops[:-1]], stops, strict=True)
                ]
                yield _found(block=block, kind=DOCUMENT, payload=payload, **rows)

        held, size = [], 0
        for batch, texts in blocks(batches, SLICE_BYTES):
            mine = sum([len(t or b"") for t in texts])
            if held and size + mine > block_bytes:
                yield from close(held)
                held, size = [], 0
            held.append(_numbers(batch.column("doc_id"), texts, tok))
            size += mine
        if held:
            yield from close(held)

    fields = "block long, kind int, key long, n long, n_a long, n_b long, n_groups long, groups_sha256 string, payload binary"
    return docs.mapInArrow(run, fields)


def _numbers(doc_id: pa.Array, texts: list[bytes | None], tok: Tokenizers) -> tuple[np.ndarray, np.ndarray, dict]:
    """(id pairs, links) of all texts one after another, and what their rows hold; a text's pairs end at its stop."""
    out = Aligned(texts, tok)
    m = len(texts)
    pair = out.a[out.link_a] << _B_BITS | out.b[out.link_b]
    document = np.repeat(np.arange(len(out.valid)), np.diff(out.first_link))
    order = np.lexsort((pair, document))
    pair, document = pair[order], document[order]
    new = np.flatnonzero(np.append(True, (np.diff(pair) != 0) | (np.diff(document) != 0))) if len(pair) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(pair)))
    per_text, n_a, n_b, n_links = (np.zeros(m, np.int64) for _ in range(4))
    per_text[out.valid] = np.bincount(document[new], minlength=len(out.valid))
    n_a[out.valid], n_b[out.valid] = np.diff(out.first_a), np.diff(out.first_b)
    n_links[out.valid] = np.diff(out.first_link)
    sha = [""] * m
    for i, groups in zip(out.valid, out.written(tok), strict=True):
        sha[i] = hashlib.sha256(groups.encode()).hexdigest()
    rows = {"key": doc_id, "n": n_links, "n_a": n_a, "n_b": n_b, "n_groups": n_links, "groups_sha256": sha, "stops": np.cumsum(per_text).tolist()}
    return pair[new], count, rows


def pair_counts(found: DataFrame) -> DataFrame:
    """(key, links, best) of every id pair: its links in all documents, and whether no pair of its B id has more."""
    counts = stored(found.where(f"kind = {PAIR}").groupBy("key").agg(F.sum("n").alias("links")), "pairs")
    b = F.col("key").bitwiseAND((1 << _B_BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("links").alias("most"))  # a row per B id: bounded by the vocabulary
    return counts.join(F.broadcast(most), b == F.col("b")).select("key", "links", (F.col("links") == F.col("most")).alias("best"))


def counted(docs: DataFrame, paths: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Digest columns of every row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = paths or default_paths()
    found = stored(_collect(id_and_text(docs), paths, block_bytes), "alignments")
    back = found.where(f"kind = {PAIR}").select("block", "kind", "key").join(pair_counts(found), "key")
    documents = found.where(f"kind = {DOCUMENT}").withColumns({"links": F.lit(None).cast("long"), "best": F.lit(None).cast("boolean")})
    empty = {c: F.lit(None).cast(t) for c, t in documents.dtypes if c not in ("block", "kind", "key", "links", "best")}
    names = documents.columns
    # of each block first the pairs in their order, then the documents
    dealt = back.withColumns(empty).select(names).union(documents).repartition("block").sortWithinPartitions("block", "kind", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        block, parts, links, best = None, [], None, None
        for batch in batches:
            blocks_, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks_) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blocks_)], strict=True):
                if hi == lo:
                    continue
                rows = batch.slice(lo, hi - lo)
                if blocks_[lo] != block:
                    block, parts, links = blocks_[lo], [], None
                if kinds[lo] == PAIR:
                    parts.append((rows.column("links").to_numpy(), rows.column("best").to_numpy(zero_copy_only=False).astype(bool)))
                    continue
                if links is None:
                    links, best = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, bool))
                    parts = []
                n_best, count_sum = [], []
                for payload in rows.column("payload").to_pylist():
                    bag = np.frombuffer(unpack(payload), np.uint32).astype(np.int64) if payload else np.zeros(0, np.int64)
                    places, counts = np.cumsum(bag[: len(bag) // 2]), bag[len(bag) // 2 :]
                    n_best.append(int(counts[best[places]].sum()))
                    count_sum.append(int((counts * links[places]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("key"), rows.column("n_a"), rows.column("n_b"), rows.column("n_groups"), rows.column("n"),
                        pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), rows.column("groups_sha256"),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return dealt.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )


def op12(docs: DataFrame) -> DataFrame:
    """Columns of the contract, one row per document."""
    return counted(docs)
