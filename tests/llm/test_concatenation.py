from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkmart.llm.concatenation import boundaries, cut, cuts, sequences, stream, tail_edges
from sparkmart.staging import Staging

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = open(PATH, encoding="utf-8").read()
PLAIN = Tokenizer.from_file(PATH)

ROWS = [(k, f"word{k} " * (k * 7)) for k in range(25)] + [
    (30, None), (31, ""), (None, "lost"), (32, "again"), (32, "again"), (33, "a b c " * 4000), (34, "日本語。テスト ſ"),
]


def ids(text):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@pytest.mark.parametrize("total", [0, 1, 63, 64, 65, 127, 128, 1000])
def test_edges(total):
    tail = tail_edges(total, 64)
    assert tail[0] == total // 64 * 64 and tail[-1] == total
    assert all((b - a).bit_count() == 1 and b - a < 64 for a, b in zip(tail, tail[1:]))
    whole = cuts(0, total, 64, tail)
    assert [c[1] for c in whole] == [0] * len(whole)
    assert [c[0] for c in whole] == list(range(len(whole)))


@pytest.mark.parametrize("parts", [1, 7])
def test_documents(sent, docs, fresh, parts):
    placed = stream(docs(ROWS).repartition(parts), sent.sparkContext.broadcast(MODEL), fresh)
    pieces = cut(placed, 64).collect()
    by_doc: dict = {}
    for r in pieces:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = {}
    for doc, text in ROWS:
        expected.setdefault((doc, len(ids(text))), []).append(ids(text))
    assert by_doc.keys() == expected.keys()
    for key, found in by_doc.items():
        whole = expected[key]
        assert sum(r.length for r in found) == sum(map(len, whole))
        for r in found:
            assert r.ids_crc32 == zlib.crc32(whole[0][r.start : r.start + r.length].tobytes())
    total = sum(len(ids(t)) for _, t in ROWS)
    rooms: dict = {}
    for r in pieces:
        rooms.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for room in rooms.values():
        at = 0
        for offset, length in sorted(room):
            assert offset == at
            at += length
        assert at == 64 or at.bit_count() == 1
    assert len(rooms) == total // 64 + (total % 64).bit_count()
    edges = boundaries(cut(placed, 64)).collect()
    assert len(edges) == sum(r.start > 0 for r in pieces)
    assert all(e.tokens_before + e.tokens_behind == next(r.doc_tokens for r in pieces if r.doc_id == e.doc_id) for e in edges)


@pytest.mark.parametrize("parts", [1, 7])
def test_sequences_hold_the_stream(sent, docs, fresh, parts):
    placed = stream(docs(ROWS).repartition(parts), sent.sparkContext.broadcast(MODEL), fresh)
    found = sorted(sequences(placed, 64).collect())
    assert [r.sequence_id for r in found] == list(range(len(found)))
    assert all(r.n_padding == 0 and len(r.ids) == 4 * r.n_tokens for r in found)
    order = sorted((r.place, r.doc_id) for r in placed.select("place", "doc_id").collect())
    texts = dict(ROWS)
    assert b"".join(r.ids for r in found) == b"".join(ids(texts[d]).tobytes() for _, d in order)


def test_padding_where_no_power_of_two(sent, docs, fresh):
    placed = stream(docs([(1, "a b c d e")]), sent.sparkContext.broadcast(MODEL), fresh)
    found = sorted(sequences(placed, 100).collect())
    assert [(r.n_tokens, r.n_padding) for r in found] == [(4, 0), (2, 0)]
    placed = stream(docs([(1, "a " * 99)]), sent.sparkContext.broadcast(MODEL), Staging(sent, fresh.folder))
    assert [(r.n_tokens, r.n_padding) for r in sequences(placed, 100).collect()] == [(100, 0)]


def test_empty(sent, docs, fresh):
    placed = stream(docs([]), sent.sparkContext.broadcast(MODEL), fresh)
    assert cut(placed).count() == 0 and sequences(placed).count() == 0


def test_long_text(sent, docs, fresh):
    text = "alpha beta, gamma. " * 200_000
    placed = stream(docs([(5, text)]), sent.sparkContext.broadcast(MODEL), fresh)
    pieces = cut(placed).collect()
    assert sum(r.length for r in pieces) == len(ids(text)) and max(r.length for r in pieces) == 2048
