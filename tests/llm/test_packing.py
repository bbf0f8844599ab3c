from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkmart.llm.packing import Capacities, WordCache, best_fit, pack, tokenized

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = open(PATH, encoding="utf-8").read()
PLAIN, CACHE = Tokenizer.from_file(PATH), WordCache(MODEL)


def ids(text):
    return np.array(PLAIN.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


HARD = [
    "", " \n\t", "it's DON'T 'll I'm", "x.y,z!? (a) \"q\" 12.5% é.", "<|endoftext|>a <|ENDOFTEXT|> <|startoftext|>.",
    "İSTANBUL ΑΣ Σ. Ǆ ﬁ ½ ẹ́ Å", "a\x1cb\x85c d\xa0e", "́a ́", "日本語。テスト", "word" * 5000 + ".", "a|>. b<| |",
]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAéÉsS'\".,!?|<> \n\t\x1ćİΣσ1²日_-", max_size=40))
def test_same_ids_as_the_library(text):
    assert CACHE.encode([text]) == [ids(text)]


def test_hard_texts():
    assert CACHE.encode(HARD) == [ids(t) for t in HARD]


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_every_capacity_holds(by):
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 101, 500))[::-1]
    room = Capacities(tokens=100, documents=4, attention=5200 if by == "dot" else 10_000, by=by)
    if by == "dot":
        lengths = lengths[lengths <= 72]
    sequence, offset = best_fit(lengths, room)
    for s in range(sequence.max() + 1):
        own = np.flatnonzero(sequence == s)
        assert lengths[own].sum() <= 100 and len(own) <= 4 and (lengths[own] ** 2).sum() <= room.attention
        assert sorted(zip(offset[own], lengths[own])) == [
            (o, n) for o, n in zip(np.cumsum(lengths[own]) - lengths[own], lengths[own])
        ]


def test_fits_perfectly_where_it_can():
    lengths = np.array([60, 60, 55, 45, 40, 40])
    assert best_fit(lengths, Capacities(tokens=100, attention=10**6))[0].max() == 2


def test_too_long_for_any():
    with pytest.raises(ValueError):
        best_fit(np.array([11]), Capacities(tokens=10))


@pytest.mark.parametrize("per_shard", [3, 10_000])
def test_documents(sent, docs, fresh, per_shard):
    rows = [(k, f"word{k} " * (k * 7)) for k in range(25)] + [(30, None), (31, ""), (None, "lost"), (32, "again"), (32, "again"), (33, "a b c " * 4000)]
    model = sent.sparkContext.broadcast(MODEL)
    found = pack(tokenized(docs(rows), model, 256), Capacities(tokens=256), per_shard, staging=fresh).collect()
    expected = []
    for doc, text in rows:
        whole = ids(text or "") + np.array([1], "<u4").tobytes()
        expected += [
            (doc, n, at // 4, len(whole[at : at + 1024]) // 4, zlib.crc32(whole[at : at + 1024]))
            for n, at in enumerate(range(0, len(whole), 1024))
        ]
    assert sorted([tuple(r)[:5] for r in found], key=repr) == sorted(expected, key=repr)
    by_sequence: dict = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    if per_shard > 100:
        assert len(by_sequence) == -(-sum(e[3] for e in expected) // 256)


def test_empty(sent, docs, fresh):
    assert pack(tokenized(docs([]), sent.sparkContext.broadcast(MODEL), 16), staging=fresh).count() == 0
