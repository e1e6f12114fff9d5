"""Small frames and brute-force versions the operator tests compare with."""

from __future__ import annotations

import random
import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: every operator has to live with these: nulls, empty, blanks, repeated rows, no letters, a long word
ODD = [
    (900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, " \n\t ", None, None, None), (None, "null id here", "en", "s", 12),
    (903, "same row twice", "en", "s", 14), (903, "same row twice", "en", "s", 14), (904, "12345 !!! ###", "de", "s", 13),
    (905, "x" * 20_000, "en", "s", 20_000), (906, "\x00\x01 nul", "en", "s", 7), (907, "日本語 テキスト 😀 é́", "ja", "s", 14),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """More columns, named like things the operators make or use themselves."""
    from pyspark.sql import functions as F

    for name in ("n_words", "score", "kept", "h", "id", "sig", "_row", "_id", "_spans", "ids", "key", "held_out", "value"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


def crc_mod(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(text))


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))
