"""Helpers shared by the operators: column selection, task-side batching, vectorised word hashing, scratch folders."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Fixed value: A-Z to a-z, all other bytes unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fixed value: every ASCII byte but 0-9 and a-z (A-Z lower-cased first) becomes a space.
ALNUM_WORDS = bytes(
    LOWER[b] if b >= 128 or chr(LOWER[b]).isalnum() else 32 for b in range(256)
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator works on; all other columns, whatever their names, are left out of the scan."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more
    )


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value as decimal text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def _as_bytes(column: pa.Array) -> pa.Array:
    """A string column as binary, without a copy."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def blocks(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cuts Arrow batches into slices of at most ``max_bytes`` of text, one document at least."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives the memory of a batch that is done back to the machine
    for batch in batches:
        column = _as_bytes(batch.column(batch.schema.get_field_index("text")))
        lens = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lens):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if start < len(lens):
            yield batch.slice(start), column.slice(start).to_pylist()


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """A value kept for the life of one Python worker (loaded models, memo tables), made again on a new worker."""
    holder = sys.modules.setdefault("_worker_cache", types.ModuleType("_worker_cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share; an error where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        ctx_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = ctx_dir.get() if ctx_dir.isDefined() else None
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


#: paths of the tables made in each open ``temporary`` block, the innermost last
_MADE: list[list[str]] = []


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later jobs start from the files, whatever executor is lost."""
    path = scratch(df.sparkSession, kind)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that ``stored`` writes inside the block go when it ends. The function it gives writes one that stays, for
    a result that is read after the block (or goes with the block around it)."""
    made: list[str] = []
    _MADE.append(made)

    def lasting(df: DataFrame, kind: str) -> DataFrame:
        out = stored(df, kind)
        path = made.pop()
        if len(_MADE) > 1:
            _MADE[-2].append(path)
        return out

    try:
        yield lasting
    finally:
        _MADE.pop()
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Hadoop's file system, wherever it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# ---- vectorised words -------------------------------------------------------------------------------------------

_P = 0x9E3779B97F4A7C15  # odd multiplier of the polynomial hash
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _S)
    x = x * _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash multiplier and of its inverse modulo 2**64; kept for the worker up to 2**20."""

    def make(m: int) -> tuple[np.ndarray, np.ndarray]:
        inv = pow(_P, -1, 1 << 64)
        up, down = np.full(m + 1, _P, np.uint64), np.full(m + 1, inv, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    if n <= 1 << 20:
        return worker_cache("powers", lambda: make(1 << 20))  # type: ignore[return-value]
    return make(n)


def word_table(separators: bytes) -> np.ndarray:
    table = np.ones(256, np.int8)
    table[list(separators)] = 0
    return table


def words_of(texts: list[bytes | None], separators: bytes = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, first word of each text and the total) of texts joined by one separator."""
    joined = separators[:1].join(t or b"" for t in texts)
    buf = np.frombuffer(joined, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = word_table(separators)[buf]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    first = np.searchsorted(starts, offsets)
    return buf, starts, ends, first


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; the same on every machine."""
    up, down = powers(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
