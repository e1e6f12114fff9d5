"""Byte-pair encoding and decoding by batched numpy merge rounds.

The vocabulary file is read as data (JSON): ids, merges and special tokens. A block of documents is cut at ASCII white
space; only chunks that the worker hasn't met before go on. Their pieces become one flat array of symbol ids, and each
round finds the rank of every adjacent pair by binary search over the sorted pair keys, picks the lowest-ranked pair of
every word and merges all its places from the left. Words are independent, so all words of a block advance together.

The worker remembers chunks and pieces in memos of two generations: when the younger holds ``MEMO`` entries it becomes
the older one, and what is met again moves to the new younger one. That bounds memory and never changes a result.

Edge cases: a null or empty text has no ids and decodes to the empty text; special tokens are cut out of the raw text
first, as the library does; other columns are ignored; repeated ids keep their rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import blocks, id_and_text, worker_cache

MEMO = 60_000
BLOCK_BYTES = 2 << 20

#: Fixed values of the tokenizer: Unicode white space, and the pattern that cuts normalised text into pieces.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + WHITE + r"\p{L}\p{N}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the others shifted to 256 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_vocabulary(text: str) -> dict:
    """Tables of a word-level BPE file: symbol ids by byte, sorted pair keys with rank and result, tokens by id."""
    spec = json.loads(text)
    vocab: dict[str, int] = spec["model"]["vocab"]
    end = spec["model"]["end_of_word_suffix"]
    letters = byte_letters()
    left, right, made = [], [], []
    for a, b in spec["model"]["merges"]:
        left.append(vocab[a])
        right.append(vocab[b])
        made.append(vocab[a + b])
    keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
    order = np.argsort(keys, kind="stable")
    tokens = {i: t for t, i in vocab.items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens |= {i: t for t, i in special.items()}
    return {
        "inner": np.array([vocab[letters[b]] for b in range(256)], np.int64),
        "last": np.array([vocab[letters[b] + end] for b in range(256)], np.int64),
        "keys": keys[order], "rank": order.astype(np.int64), "made": np.array(made, np.int64)[order],
        "tokens": tokens, "special": special,
    }


def merge_rounds(words: list[bytes], vocab: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word starts in it (one entry more than words)."""
    keys, rank, made = vocab["keys"], vocab["rank"], vocab["made"]
    raw = np.frombuffer(b"".join(words), np.uint8)
    lens = np.array([len(w) for w in words], np.int64)
    stops = np.cumsum(lens)
    symbols = vocab["inner"][raw]
    symbols[stops - 1] = vocab["last"][raw[stops - 1]]
    word = np.repeat(np.arange(len(words)), lens)
    done_symbols, done_word, done_at = [], [], []
    at = np.arange(len(symbols))  # place in the input, to put finished words back in order
    none = np.int64(len(keys))
    while len(symbols):
        pair = symbols[:-1] << 32 | symbols[1:]
        found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        ranks = np.where((keys[found] == pair) & (word[:-1] == word[1:]), rank[found], none)
        ranks = np.append(ranks, none)
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(ranks, heads)
        size = np.diff(np.append(heads, len(symbols)))
        over = np.repeat(best == none, size)
        if over.any():  # words without a pair left are finished
            done_symbols.append(symbols[over])
            done_word.append(word[over])
            done_at.append(at[over])
            live = ~over
            symbols, word, at, ranks = symbols[live], word[live], at[live], ranks[live]
            best, size = best[best < none], size[best < none]
            if not len(symbols):
                break
        hit = ranks == np.repeat(best, size)
        if (hit[1:] & hit[:-1]).any():  # of overlapping places (a pair of equal symbols) every second one from the left
            idx = np.flatnonzero(hit)
            run = np.cumsum(np.append(True, np.diff(idx) != 1)) - 1
            first = idx[np.flatnonzero(np.append(True, np.diff(idx) != 1))]
            hit[idx[(idx - first[run]) % 2 == 1]] = False
        places = np.flatnonzero(hit)
        symbols[places] = made[np.searchsorted(keys, symbols[places] << 32 | symbols[places + 1])]
        stay = np.ones(len(symbols), bool)
        stay[places + 1] = False
        symbols, word, at = symbols[stay], word[stay], at[stay]
    if not done_symbols:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    ids, word, at = np.concatenate(done_symbols), np.concatenate(done_word), np.concatenate(done_at)
    order = np.argsort(at, kind="stable")
    return ids[order], np.searchsorted(word[order], np.arange(len(words) + 1))


def make_splitter(path: str):
    """A function from chunks of raw text without ASCII white space to the list of all their pieces, in order, with a
    blank after those of each chunk."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    normalise, cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
    back = {ord(c): b for b, c in enumerate(byte_letters())}
    pieces = regex.compile(PIECES + r"|\x20").findall
    beyond = regex.compile(r"[^\x00-\u024f]").search

    def split(chunks: list[str]) -> list[str]:
        text = " ".join(chunks) + " "
        if not beyond(text):  # below U+0250 the normalisation is lower-casing alone
            return pieces(text.lower())
        out = []
        for c in chunks:
            if beyond(c):  # whose letters depend on the Unicode version, so the library cuts them itself
                out += [p.translate(back).encode("latin-1").decode() for p, _ in cut(normalise(c))]
            else:
                out += pieces(c.lower())
            out.append(" ")
        return out

    return split


class Memo:
    """A dictionary of bounded size in two generations."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Keys that have no entry; the others are in the younger generation afterwards."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for k in keys.difference(young):
            if (e := old.get(k)) is not None:
                young[k] = e
            else:
                new.append(k)
        return new


class Encoder:
    """Encodes chunks of text. ``entries_of`` makes the entries of new pieces, ``special`` those of special tokens, and
    ``combine`` the entry of a chunk from its pieces' entries."""

    def __init__(self, path: str, entries_of, special: dict[str, object], combine, memo: int = MEMO):
        self.split, self.entries_of, self.special, self.combine = make_splitter(path), entries_of, special, combine
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in special) + ")") if special else None
        self.chunks, self.pieces = Memo(memo), Memo(memo)

    def learn(self, new: list[bytes]) -> None:
        """Adds entries of the chunks ``new``, all their new pieces in one batch."""
        plain = [c for c in new if b"<" not in c] if self.cut is not None else new
        tokens = self.split([c.decode("utf-8", "replace") for c in plain]) if plain else []
        parts: list[tuple[bytes, list]] = []  # chunks that may hold special tokens
        every = set(tokens)
        if len(plain) < len(new):
            for chunk in new:
                if b"<" in chunk:
                    own: list = []
                    for text in self.cut.split(chunk.decode("utf-8", "replace")):
                        if text in self.special:
                            own.append(self.special[text])
                        elif text:
                            found = [p for p in self.split([text]) if p != " "]
                            every.update(found)
                            own += found
                    parts.append((chunk, own))
        every.discard(" ")
        words = self.pieces.missing(every)
        known = self.pieces.young
        known.update(zip(words, self.entries_of(words), strict=True))
        young, combine = self.chunks.young, self.combine
        chunks, own = iter(plain), []
        for t in tokens:
            if t != " ":
                own.append(known[t])
            else:
                young[next(chunks)] = own[0] if len(own) == 1 else combine(own)
                own = []
        for chunk, own in parts:
            young[chunk] = combine([known[p] if p.__class__ is str else p for p in own])

    def block(self, texts: list[bytes | None]) -> Iterator[list]:
        """For each text the entries of its chunks, in order."""
        return map(list, self.entries(texts))

    def entries(self, texts: list[bytes | None]) -> Iterator[Iterator]:
        """The same, to be read before the next block."""
        cut = [t.split() if t else [] for t in texts]
        new = self.chunks.missing(set().union(*cut))
        if new:
            self.learn(new)
        get = self.chunks.young.__getitem__
        for chunks in cut:
            yield map(get, chunks)


def numpy_words(vocab: dict):
    """Ids of pieces by merge rounds."""

    def encode(words: list[str]) -> list[tuple[int, ...]]:
        if not words:
            return []
        ids, at = merge_rounds([w.encode() for w in words], vocab)
        flat, stops = ids.tolist(), at.tolist()
        return [tuple(flat[a:b]) for a, b in zip(stops[:-1], stops[1:], strict=True)]

    return encode


def _encoder(path: str, texts: bool) -> Encoder:
    """``texts``: entries hold the ids as decimal text, else as 32-bit numbers; both with their count and tokens."""
    with open(path, encoding="utf-8") as f:
        vocab = read_vocabulary(f.read())
    tokens, words_to_ids = vocab["tokens"], numpy_words(vocab)

    def entry(ids) -> tuple:
        own = " ".join(map(str, ids)) if texts else np.array(ids, np.int32).tobytes()
        return own, len(ids), " ".join([tokens[i] for i in ids])

    def combine(entries: list[tuple]) -> tuple:
        joined = " ".join([e[0] for e in entries]) if texts else b"".join([e[0] for e in entries])
        return joined, sum([e[1] for e in entries]), " ".join([e[2] for e in entries])

    special = {s: entry([i]) for s, i in vocab["special"].items()}
    return Encoder(path, lambda words: [entry(ids) for ids in words_to_ids(words)], special, combine)


def encoded(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with ``ids`` (array<int>) and ``decoded`` (the tokens of the ids
    joined by one blank, as the tokenizer without a decoder has it). The tokenizer file is read on each worker."""
    path = path or default_path()
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache("bpe" + path, lambda: _encoder(path, False))
        for rows, texts in blocks(batches, BLOCK_BYTES):
            ids, decoded, ends = [], [], [0]
            for entries in encoder.entries(texts):
                entries = [e for e in entries if e[1]]
                ids += [e[0] for e in entries]
                ends.append(ends[-1] + sum([e[1] for e in entries]))
                decoded.append(" ".join([e[2] for e in entries]))
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in keep), lists, pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, "ids array<int>, decoded string"]))


def digested(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with n_tokens, ids_sha256 and decoded_sha256: what ``encoded``
    has, as digests of the decimal ids joined by one blank and of the decoded text."""
    path = path or default_path()
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache("bpe-text" + path, lambda: _encoder(path, True))
        sha = lambda parts: hashlib.sha256(" ".join(parts).encode()).hexdigest()
        for rows, texts in blocks(batches, BLOCK_BYTES):
            n, ids, decoded = [], [], []
            for entries in encoder.entries(texts):
                entries = [e for e in entries if e[1]]
                n.append(sum([e[1] for e in entries]))
                ids.append(sha([e[0] for e in entries]))
                decoded.append(sha([e[2] for e in entries]))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, "n_tokens long, ids_sha256 string, decoded_sha256 string"]))


def decode(ids: list[int], path: str | None = None) -> str:
    """The text of a list of ids: their tokens joined by one blank."""
    path = path or default_path()

    def load() -> dict[int, str]:
        with open(path, encoding="utf-8") as f:
            return read_vocabulary(f.read())["tokens"]

    tokens = worker_cache("tokens" + path, load)
    return " ".join(tokens[i] for i in ids)


def op2(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract, one row per document."""
    return digested(id_and_text(docs), keep=["doc_id"])
