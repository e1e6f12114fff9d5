from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfroll.llm import bpe, token_files
from shelfroll.llm.common import scratch

from .helpers import ODD, frame, rows_of, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
TEXTS = [
    "Hello, it's the tokenizer we've got!", "aaaaaaa hahahaha banana", "<|startoftext|>x<|endoftext|> <|STARTOFTEXT|>",
    "J̌ ǰ İ K ﬁ ½ Σς", "a\x1cb\x85c\xa0d e", "tab\tnew\nline\r\n", "naïve café 東京 😀😀", "x" * 3000, "", "'s'S 'RE're",
]


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe._encoder(PATH, True)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabAB'<|>.é́̌J12"), st.characters(codec="utf-8")), max_size=60))
def test_merge_rounds_equal_the_library(text):
    enc = test_merge_rounds_equal_the_library.__dict__.setdefault("enc", bpe._encoder(PATH, True))
    (entries,) = enc.block([text.encode()])
    assert [int(i) for e in entries for i in e[0].split()] == ids(text)


def test_small_memo_gives_the_same_ids(encoder):
    small = bpe._encoder(PATH, True)
    small.chunks.limit = small.pieces.limit = 3
    texts = [t.encode() for t in TEXTS]
    assert [*small.block(texts)] == [*encoder.block(texts)] == [*small.block(texts)]


def test_encoded_and_digests(spark):
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)] + ODD)
    want = {d: t for d, t, *_ in [(i, t) for i, t in enumerate(TEXTS)] + [r[:2] for r in ODD]}
    plain = rows_of(bpe.encoded(docs.select("doc_id", "text")))
    digest = rows_of(bpe.op2(with_clashes(docs)))
    assert bpe.op2(docs).count() == docs.count()
    for d, t in want.items():
        tokens = ids(t)
        decoded = LIB.decode(tokens, skip_special_tokens=False)
        assert plain[d]["ids"] == tokens and plain[d]["decoded"] == decoded == bpe.decode(tokens)
        assert digest[d] == {
            "doc_id": d, "n_tokens": len(tokens), "ids_sha256": hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
        }
    assert bpe.op2(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "values", [[0], [0, 0, 0], [0, 5, 5, 9, 10**6], [*range(1000)], [0] * 700 + [7], sorted(random.Random(1).sample(range(10**9), 3000))]
)
def test_elias_fano_round_trip_and_select(values):
    section, _ = token_files.ef_open(memoryview(token_files.ef_encode(np.array(values))))
    assert token_files.ef_all(section).tolist() == values
    assert [token_files.ef_select(section, i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        token_files.ef_select(section, len(values))


def test_elias_fano_takes_few_bits():
    values = np.cumsum(np.random.default_rng(2).integers(0, 2000, 100_000))
    assert 8 * len(token_files.ef_encode(values)) < len(values) * (2 + np.log2(values[-1] / len(values)) + 1)


def test_files_hold_documents_in_order(spark, monkeypatch):
    docs = frame(spark, [(i * 7 % 10 - 3, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)] + ODD)
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    out = {}
    for r in token_files.op4(with_clashes(docs)).collect():
        out.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    start = 0
    for r in ordered:
        own = ids(r.text) + [1]
        assert (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())) in out[r.doc_id]
        start += len(own)
    assert sum(map(len, out.values())) == len(ordered)
    assert token_files.op4(docs.limit(0)).count() == 0


def test_several_files_and_ids_read_back(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 40)
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)])
    manifest = token_files.write_files(docs, scratch(spark, "test"))
    assert len(manifest) > 1 and manifest[-1]["before"] + manifest[-1]["n_ids"] == sum(len(ids(t)) + 1 for t in TEXTS)
    back = rows_of(token_files.read_files(spark, manifest))
    assert {d: r["ids"] for d, r in back.items()} == {i: ids(t) + [1] for i, t in enumerate(TEXTS)}
