from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfroll.llm import token_alignment as ta
from shelfroll.llm.bpe import byte_letters

from .helpers import ODD, frame, with_clashes

#: strings of special tokens, contractions, blanks of all kinds, letters beyond Latin, marks, a blank's stand-in
TEXTS = [
    "<|endoftext|> and <s> </s> <unk> <0x41>", "it's we'll I'M  two  blanks\t\ttabs\n\n lines \r\n end ", " leading", "a▁b", "▁",
    "Größe naïve Ångström ÆSOP ﬁ ſ ²³ ª½", "русский 中文字 عربى ไทย 한국어 😀👩‍👩‍👧 é", "x1y2 1234567890 3.14159", " nbsp　wide em\u0085nel",
    "z" * 5000, " " * 3000, "\x00\x01\x1f\x7f", "ab" * 700 + "!?" * 800, "\n",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = ta.default_paths()
    one, two = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
    one.encode_special_tokens = True
    return one, two


def brute(rows, libraries):
    """The contract's rows from the two libraries, one document at a time."""
    one, two = libraries
    back = {c: b for b, c in enumerate(byte_letters())}
    name = {i: s for s, i in one.get_vocab().items()}
    found, counts = [], Counter()
    for doc_id, text, *_ in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in name[i]) for i in a]
        pieces = [two.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        whole = (" " + (text or "")).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends = {}
        for side, (ids, parts) in enumerate(((a, bytes_a), (b, bytes_b))):
            at = 0
            for i, part in zip(ids, parts, strict=True):
                at += len(part)
                ends.setdefault(at, ([], []))[side].append(i)
        groups, links, left, right = [], [], [], []
        for at in sorted(ends):
            left += ends[at][0]
            right += ends[at][1]
            links += [(x, y) for x in ends[at][0] for y in ends[at][1]]
            if ends[at][0] and ends[at][1]:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        assert not left and not right
        counts.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (
            (
                -1 if i is None else i, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
            )
            for i, n_a, n_b, groups, links in found
        ),
    )


def rows_of(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(tuple(-1 if r[c] is None else r[c] for c in names) for r in df.collect())


def corpus():
    rng = random.Random(11)
    docs = [*ODD] + [(2000 + i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)]
    hot = "The quick brown fox isn't here; das Äußerste, déjà vu. " * 40
    for i in range(60):
        text = hot if i % 3 == 0 else " ".join(rng.choice(["Wörter", "prose", "naïveté", "tokenisation", "1984", "x" * rng.randrange(9), "the"]) for _ in range(rng.choice([1, 30, 700])))
        docs.append((i, text, "en", "s", len(text)))
    return docs


@pytest.mark.parametrize("block_bytes", [1, 20_000, ta.BLOCK_BYTES])
def test_rows_equal_the_libraries_whatever_the_blocks(spark, libraries, block_bytes):
    docs = corpus()
    want = brute(docs, libraries)
    df = with_clashes(frame(spark, docs).repartition(3))
    assert rows_of(ta.counted(df, block_bytes=block_bytes)) == want


def test_repeated_tables_of_equal_blocks_stay_apart(spark, libraries):
    docs = [(5, "same rows in every partition", "en", "s", 1)] * 12
    got = ta.counted(frame(spark, docs).repartition(4), block_bytes=1)
    assert rows_of(got) == brute(docs, libraries)


def test_alignments_return_ids_links_and_cuts(spark, libraries):
    one, two = libraries
    docs = corpus()
    got = {r["doc_id"]: r for r in ta.alignments(with_clashes(frame(spark, docs))).collect()}
    for doc_id, text, *_ in docs:
        r = got[doc_id]
        if not text or "▁" in text:
            assert not r["a_ids"] and not r["b_ids"] and not r["links"] and not r["cuts"]
            continue
        assert r["a_ids"] == one.encode(" " + text, add_special_tokens=False).ids and r["b_ids"] == two.encode(text)
        assert len(r["cuts"]) == len(r["links"]) and r["cuts"][-1] == len(text.encode()) + 1
        assert r["links"][-1].asDict() == {"a": len(r["a_ids"]) - 1, "b": len(r["b_ids"]) - 1}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sStTreElL1²½ßéÀ×ª<|>_-x ́中🙂"), st.characters(codec="utf-8")), min_size=1, max_size=60))
def test_rank_encoder_equals_the_tokenizer_file(text):
    tok = ta._loaded(ta.default_paths())
    assert tok.a.encode(" " + text, (" " + text).encode()) == tok.a.own.encode(" " + text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_lockstep_finds_every_common_end_at_any_lane_length(data):
    texts = data.draw(st.lists(st.integers(1, 40), min_size=1, max_size=5))
    ends_a, ends_b, first_a, first_b, base = [], [], [0], [0], 0
    for n in texts:
        for ends, first in ((ends_a, first_a), (ends_b, first_b)):
            inner = data.draw(st.sets(st.integers(1, n - 1))) if n > 1 else set()
            ends += [base + x for x in sorted(inner | {n})]
            first.append(len(ends))
        base += n
    a, b = np.array(ends_a), np.array(ends_b)
    _, want_a, want_b = np.intersect1d(a, b, return_indices=True)
    for lane in (1, 2, 5, 1000):
        got = ta.lockstep(a, b, *ta.lanes(a, b, np.array(first_a), np.array(first_b), lane))
        assert got[0].tolist() == want_a.tolist() and got[1].tolist() == want_b.tolist()


def test_a_long_document_takes_no_more_steps_than_its_lanes():
    a = np.arange(1, 200_001) * 3
    start, _, stop = ta.lanes(a, a, np.array([0, len(a)]), np.array([0, len(a)]))
    assert (stop - start).max() <= ta.LANE


def test_empty_table(spark):
    assert ta.op12(frame(spark, [])).count() == 0
    assert rows_of(ta.op12(frame(spark, [(1, None, "en", "s", 0), (None, "", "en", "s", 0)]))) == [(-1, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
