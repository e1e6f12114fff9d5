"""Token-id files: one concatenated id array per file, document boundaries in Elias-Fano form.

Documents are range-partitioned and sorted by id, encoded and appended to a file until it holds ``FILE_IDS`` ids; a
task that has more opens the next file, so memory doesn't grow with the partition. Files lie in the shared folder; a
file counts only if a finished task names it, so lost executors and repeated attempts leave no wrong data. The driver
gets one manifest row per file and adds the number of ids before each.

File layout, little-endian::

    magic  8 bytes | id width (2 or 4), null ids, documents, ids: 4 x u64 | lowest doc_id: i64
    boundaries: Elias-Fano of documents + 1 numbers | doc_ids less the lowest: Elias-Fano (documents without null id)
    ids

An Elias-Fano section is ``count, universe, low bits, high bytes, samples: 5 x u64``, the packed low bits, the unary
high bits and the select directory: the bit place of every 256th one as u32. Reading takes the boundaries of a few
thousand documents at a time from there.

Edge cases: null or empty texts hold the end id alone; null doc_ids come first; equal doc_ids are ordered by text; an
empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder, byte_letters, default_path, read_vocabulary
from .common import blocks, id_and_text, scratch, worker_cache

MAGIC = b"EFTOKEN1"
END_ID = 1
FILE_IDS = 12_000_000
SAMPLE = 256
READ_DOCS = 4096  # documents whose boundaries are expanded at a time
BLOCK_BYTES = 4 << 20
MEMO = 200_000  # chunks remembered: their entries are a few bytes here


# ---- Elias-Fano ---------------------------------------------------------------------------------------------------


def ef_encode(values: np.ndarray) -> bytes:
    """A non-decreasing array of non-negative numbers in about 2 + log2(universe / count) bits each."""
    n = len(values)
    universe = int(values[-1]) if n else 0
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    values = values.astype(np.uint64)
    high = np.zeros(0, np.uint8)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    if n:
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little")
    lows = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(lows.ravel(), bitorder="little")
    samples = places[::SAMPLE].astype("<u4")
    return struct.pack("<5Q", n, universe, low, len(high), len(samples)) + packed.tobytes() + high.tobytes() + samples.tobytes()


def ef_open(data: memoryview, at: int = 0) -> tuple[dict, int]:
    """A section as a dict of arrays, and where the next section starts."""
    n, universe, low, n_high, n_samples = struct.unpack_from("<5Q", data, at)
    at += 40
    n_low = (n * low + 7) // 8
    section = {
        "n": n, "low": low, "universe": universe,
        "lows": np.frombuffer(data, np.uint8, n_low, at),
        "high": np.frombuffer(data, np.uint8, n_high, at + n_low),
        "samples": np.frombuffer(data, "<u4", n_samples, at + n_low + n_high),
    }
    return section, at + n_low + n_high + 4 * n_samples


def ef_all(section: dict) -> np.ndarray:
    """All values of a section."""
    n, low = section["n"], section["low"]
    ones = np.flatnonzero(np.unpackbits(section["high"], bitorder="little"))[:n]
    out = (ones - np.arange(n)).astype(np.uint64) << np.uint64(low)
    if low:
        bits = np.unpackbits(section["lows"], bitorder="little", count=n * low).reshape(n, low)
        out += bits.astype(np.uint64) @ (np.uint64(1) << np.arange(low, dtype=np.uint64))
    return out


def ef_select(section: dict, i: int) -> int:
    """Value ``i``, from one directory entry, a count of ones over the high bits after it, and ``low`` low bits."""
    if not 0 <= i < section["n"]:
        raise IndexError(i)
    place, left = int(section["samples"][i // SAMPLE]), i % SAMPLE
    byte = place // 8
    skip = place % 8
    while left:
        bits = np.unpackbits(section["high"][byte : byte + 64], bitorder="little")
        bits[: skip + 1] = 0
        ones = np.flatnonzero(bits)
        if len(ones) >= left:
            place, left = byte * 8 + int(ones[left - 1]), 0
        else:
            left -= len(ones)
            byte, skip = byte + 64, -1
    value = place - i
    low = section["low"]
    for k in range(low):
        b = i * low + (low - 1 - k)
        value = value << 1 | (int(section["lows"][b // 8]) >> (b % 8) & 1)
    return value


def ef_range(section: dict, lo: int, hi: int) -> np.ndarray:
    """Values ``lo`` to ``hi`` (exclusive): a select for the first, then a scan of the high bits after it as far as
    needed and a slice of the low bits. Nothing else of the section is expanded."""
    n, low = hi - lo, section["low"]
    if n <= 0:
        return np.zeros(0, np.uint64)
    place = (ef_select(section, lo) >> low) + lo
    byte, found, have = place // 8, [], 0
    while have < n:
        chunk = section["high"][byte : byte + max(64, n // 2)]
        ones = np.flatnonzero(np.unpackbits(chunk, bitorder="little")) + 8 * byte
        ones = ones[ones >= place]
        found.append(ones)
        have += len(ones)
        byte += len(chunk)
    ones = np.concatenate(found)[:n]
    out = (ones - np.arange(lo, hi)).astype(np.uint64) << np.uint64(low)
    if low:
        first = lo * low // 8
        bits = np.unpackbits(section["lows"][first : (hi * low + 7) // 8], bitorder="little")[lo * low - 8 * first :][: n * low]
        out += bits.reshape(n, low).astype(np.uint64) @ (np.uint64(1) << np.arange(low, dtype=np.uint64))
    return out


# ---- files --------------------------------------------------------------------------------------------------------


def _open(path: str, write: bool):
    system, inner = fs.FileSystem.from_uri(path)
    if write:
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        return system.open_output_stream(inner)
    return system.open_input_stream(inner)


def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of one file; ``ids`` holds each document's ids as little-endian numbers of ``width`` bytes."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = np.cumsum([0] + [len(x) // width for x in ids])
    head = struct.pack("<4Qq", width, len(doc_ids) - len(known), len(doc_ids), int(bounds[-1]), least)
    return b"".join([MAGIC, head, ef_encode(bounds), ef_encode(known.astype(np.uint64) - np.uint64(least % (1 << 64))), *ids])


def opened(data: bytes) -> dict:
    """One file: its number of documents ``n`` and of those without id (which come first), the sections of boundaries
    and ids of documents, the lowest doc_id, and all token ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    width, nulls, n, total, least = struct.unpack_from("<4Qq", data, 8)
    view = memoryview(data)
    bounds, at = ef_open(view, 8 + 40)
    known, at = ef_open(view, at)
    if n != nulls + known["n"] or bounds["n"] != n + 1:
        raise ValueError("damaged token file")
    return {"n": n, "nulls": nulls, "bounds": bounds, "known": known, "least": least, "ids": np.frombuffer(view, f"<u{width}", total, at)}


def doc_ids_of(file: dict, lo: int, hi: int) -> list[int | None]:
    """Ids of the documents ``lo`` to ``hi`` (exclusive) of a file."""
    nulls = file["nulls"]
    known = ef_range(file["known"], max(lo - nulls, 0), max(hi - nulls, 0)) + np.uint64(file["least"] % (1 << 64))
    return [None] * (min(hi, nulls) - min(lo, nulls)) + known.astype(np.int64).tolist()


def unpack(data: bytes) -> tuple[list[int | None], dict, np.ndarray]:
    """(doc_ids, boundary section, ids) of one file."""
    file = opened(data)
    return doc_ids_of(file, 0, file["n"]), file["bounds"], file["ids"]


def _library_encoder(path: str) -> tuple[Encoder, int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        vocab = read_vocabulary(f.read())
    width = 2 if max(vocab["tokens"]) < 1 << 16 else 4
    letters = dict(enumerate(byte_letters()))
    tokenize = tokenizer.model.tokenize
    own = [i.to_bytes(width, "little") for i in range(max(vocab["tokens"]) + 1)]

    def entries(new: list[str]) -> list[bytes]:
        out = []
        for w in new:
            text = w if w.isascii() and w.isalnum() else w.encode().decode("latin-1").translate(letters)
            out.append(b"".join([own[t.id] for t in tokenize(text)]))
        return out

    special = {s: own[i] for s, i in vocab["special"].items()}
    return Encoder(path, entries, special, b"".join, memo=MEMO), width


def write_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> list[dict]:
    """Encodes ``docs`` with the tokenizers library and writes token files in ascending doc_id order.

    Returns the manifest: one dict per file, in order, with path, number of documents and ids, and ids before it.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = worker_cache("library" + path, lambda: _library_encoder(path))
        end = end_id.to_bytes(width, "little")
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        size = seq = 0

        def flush() -> pa.RecordBatch:
            name = f"{folder}/{part:06d}-{seq:05d}-{attempt}.tokens"
            with _open(name, True) as out:
                out.write(pack(doc_ids, ids, width))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "path": [name], "n_docs": [len(doc_ids)], "n_ids": [size]}
            )

        for rows, texts in blocks(batches, BLOCK_BYTES):
            for d, entries in zip(rows.column("doc_id").to_pylist(), encoder.entries(texts), strict=True):
                entry = b"".join(entries) + end
                doc_ids.append(d)
                ids.append(entry)
                size += len(entry) // width
                if size >= FILE_IDS:
                    yield flush()
                    seq += 1
                    doc_ids, ids, size = [], [], 0
        if doc_ids:
            yield flush()

    rows = id_and_text(docs)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = ordered.mapInArrow(run, "part long, seq long, path string, n_docs long, n_ids long").collect()
    manifest, before = [], 0
    for r in sorted(written, key=lambda r: (r.part, r.seq)):
        manifest.append({"path": r.path, "n_docs": r.n_docs, "n_ids": r.n_ids, "before": before})
        before += r.n_ids
    return manifest


def read_files(spark: SparkSession, manifest: list[dict], ids: bool = True) -> DataFrame:
    """Rows of the files: doc_id, start (ids of all documents before it), n_tokens, ids (or, without ``ids``, the
    unsigned crc32 of the ids as little-endian 32-bit numbers)."""
    more = "ids array<int>" if ids else "ids_crc32 long"
    files = spark.createDataFrame([(m["path"], m["before"]) for m in manifest], "path string, before long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column("path").to_pylist(), b.column("before").to_pylist(), strict=True):
                with _open(path, False) as f:
                    file = opened(f.read())
                for lo in range(0, file["n"], READ_DOCS):
                    hi = min(lo + READ_DOCS, file["n"])
                    bounds = ef_range(file["bounds"], lo, hi + 1).astype(np.int64)
                    at = bounds.tolist()
                    parts = [file["ids"][s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
                    last = pa.array(parts, pa.list_(pa.int32())) if ids else pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids_of(file, lo, hi), pa.int64()), pa.array(bounds[:-1] + before), pa.array(np.diff(bounds)), last],
                        names=["doc_id", "start", "n_tokens", "ids" if ids else "ids_crc32"],
                    )

    if manifest:
        files = files.repartition(len(manifest))
    return files.mapInArrow(run, f"doc_id long, start long, n_tokens long, {more}")


def op4(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract, read back from the files."""
    spark = docs.sparkSession
    return read_files(spark, write_files(docs, scratch(spark, "tokens")), ids=False)
