from __future__ import annotations

import hashlib
import random

import pytest

from sparkmart.llm import repeats
from sparkmart.llm.repeats import WINDOW, cut_repeats, intervals, maximal_repeats


def brute(rows):
    """By the rule itself; null ids come last."""
    def key(doc):
        return repeats.LAST_ID if doc is None else doc

    first: dict[bytes, int] = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for s in range(len(raw) - WINDOW + 1):
            w = raw[s : s + WINDOW]
            first[w] = min(first.get(w, repeats.LAST_ID), key(doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - WINDOW + 1):
            if first[raw[s : s + WINDOW]] < key(doc):
                gone[s : s + WINDOW] = b"\1" * WINDOW
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(30, 160))) for _ in range(6)]
    rows = []
    for k in range(70):
        parts = []
        for _ in range(rng.randrange(5)):
            passage = rng.choice(shared)
            cut = rng.randrange(len(passage) // 2)
            parts.append(rng.choice([passage, passage[cut:], passage[:-cut] if cut else passage]))
            parts.append("".join(rng.choice("xyz ü") for _ in range(rng.randrange(40))))
        rows.append((rng.randrange(1000) * 2, "".join(parts)))
    rows += [(1, None), (3, ""), (5, "short"), (7, "short"), (9, "a" * 49), (11, "a" * 49), (13, "b" * 50), (15, "b" * 50)]
    rows += [(17, "c" * 400), (19, "c" * 90 + "d"), (21, shared[0] * 3), (23, shared[0] * 2), (None, shared[1] * 2), (None, shared[1] * 2)]
    rows += [rows[0], (rows[1][0], "another text under one id " + shared[2] * 2), (25, "".join(shared) * 300)]
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 2000), (2, 2), (3, 0)])
def test_against_the_rule(docs, fresh, seed, hot):
    rows = cases(seed)
    found = cut_repeats(
        docs(rows), staging=fresh, bucket_bytes=4096, broadcast_keys=0 if seed == 1 else 10**6, hot_contexts=hot
    )
    assert sorted([tuple(r) for r in found.collect()], key=repr) == brute(rows)


def test_kept_bytes(docs, fresh):
    passage = "p" * 30 + "q" * 30
    found = cut_repeats(docs([(1, passage), (2, f"é{passage}ü"), (3, None), (4, passage)]), staging=fresh, with_bytes=True)
    assert {r.doc_id: bytes(r.kept).decode() for r in found.collect()} == {1: passage, 2: "éü", 3: "", 4: ""}


def test_interval_tree():
    strings = sorted([b"banana", b"bandana", b"ban", b"apple", b"bandit", b"banana"])
    found = {(n, a, b) for n, _, a, b in intervals(strings) if n > 0}
    assert found == {(3, 1, 5), (6, 2, 3), (4, 4, 5)}


def test_maximal_repeats_have_all_occurrences():
    """Three contexts agree behind the anchor, two of them also before it."""
    gram, tail = b"g" * repeats.GRAM, b"t" * 31
    entries = [(b"xaaaa" + gram + tail, 5), (b"yaaaa" + gram + tail, 5), (b"zzbbb" + gram + tail, 5)]
    found = [(sorted(m), behind, ahead) for m, behind, ahead, _, _ in maximal_repeats(entries)]
    assert ([0, 1, 2], 0, 50) in found and ([0, 1], 4, 50) in found


def test_empty(docs, fresh):
    assert cut_repeats(docs([]), staging=fresh).count() == 0
