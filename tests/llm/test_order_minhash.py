from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import order_minhash as om
from sparkmart.llm.decontaminate import words_of


def plain_similarity(a, b):
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            here = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(here, row[j])
            before = here
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(words, rate, rng):
    out = []
    for w in words:
        r = rng.random()
        if r < rate / 2:
            out.append(f"new{rng.randrange(10**6)}")
        elif r < rate:
            continue
        else:
            out.append(w)
    return out


def test_banded_alignment():
    rng = random.Random(1)
    for _ in range(300):
        words = [str(rng.randrange(rng.choice([3, 50, 10**6]))) for _ in range(rng.randrange(1, 90))]
        a = om.shingle_hashes(words_of(" ".join(words)))
        b = om.shingle_hashes(words_of(" ".join(edited(words, rng.choice([0, 0.02, 0.05, 0.3]), rng))))
        real, found = plain_similarity(a.tolist(), b.tolist()), om.similarity(a, b)
        assert found == (pytest.approx(real) if real >= 0.8 else 0.0)


def may_reach(a, b):
    """Whether texts with these shingle counts share enough of them, in whatever order."""
    common, total = sum((a & b).values()), sum(a.values()) + sum(b.values())
    return common >= 0.8 * (total - common)


def brute(rows):
    shingles = [om.shingle_hashes(words_of(t or "")) for _, t in rows]
    counts = [Counter(s.tolist()) for s in shingles]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            same = (rows[x][1] or "") == (rows[y][1] or "")
            worth = len(shingles[x]) and len(shingles[y]) and may_reach(counts[x], counts[y])
            if same or worth and plain_similarity(shingles[x].tolist(), shingles[y].tolist()) >= 0.8:
                root[find(x)] = find(y)
    groups: dict = {}
    for x, (doc, _) in enumerate(rows):
        groups.setdefault(find(x), []).append(doc)
    out = []
    for own in groups.values():
        ids = [i for i in own if i is not None]
        out += [(i, min(ids) if ids else None, len(own)) for i in own]
    return sorted(out, key=repr)


def cases():
    rng = random.Random(7)
    rows, k = [], 0
    passage = [f"p{j}" for j in range(40)]
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(40, 160))]
        if rng.random() < 0.6:
            base = base[:30] + passage + base[30:60]  # families that share a passage
        for _ in range(rng.randrange(1, 9)):
            rows.append((k := k + 1, " ".join(edited(base, rng.choice([0, 0.01, 0.03, 0.06]), rng))))
    chain = [f"c{j}" for j in range(100)]
    for _ in range(6):  # each near the one before, the ends far apart
        rows.append((k := k + 1, " ".join(chain)))
        chain = [*chain[8:], *[f"c{k}x{j}" for j in range(8)]]
    rows += [(900, None), (901, ""), (902, "!!"), (903, "Two words"), (904, "two WORDS"), (905, "two words"), (None, rows[0][1])]
    rows += [rows[3], (None, "alone without an id"), (906, "long " * 3 + " ".join(f"x{j}" for j in range(9000)))]
    return rows


@pytest.fixture(scope="module")
def expected():
    return brute(cases())


@pytest.mark.parametrize("options", [{}, {"broadcast_keys": 0, "single_rounds": 0}])
def test_classes(docs, fresh, expected, options):
    found = om.classes(docs(cases()), staging=fresh, **options)
    assert sorted([(r.doc_id, r.class_id, r.class_size) for r in found.collect()], key=repr) == expected


def test_one_of_each(docs, fresh, expected):
    rows = docs(cases())
    kept = om.one_of_each(rows, staging=fresh)
    assert kept.columns == rows.columns
    found = [r.doc_id for r in kept.collect()]
    firsts = {c for _, c, _ in expected if c is not None}
    assert sorted(i for i in found if i is not None) == sorted(firsts) and found.count(None) == 1


def test_sketches_follow_order():
    words = [f"w{k}" for k in range(60)]
    same = om.sketches(om.shingle_hashes(words_of(" ".join(words))))
    again = om.sketches(om.shingle_hashes(words_of(" ".join(words).upper())))
    turned = om.sketches(om.shingle_hashes(words_of(" ".join(words[30:] + words[:30]))))
    assert (same == again).all() and np.mean(same == turned) < 0.6


def test_empty(docs, fresh):
    assert om.classes(docs([]), staging=fresh).count() == 0


def classes_of(rows):
    """The classes by comparing all pairs, for many texts."""
    shingles = [om.shingle_hashes(words_of(t)) for _, t in rows]
    counts = [Counter(s.tolist()) for s in shingles]
    root = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            if root[x] != root[y] and may_reach(counts[x], counts[y]) and om.similarity(shingles[x], shingles[y]) >= 0.8:
                root = [root[y] if r == root[x] else r for r in root]
    return {frozenset(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root)}


def found_classes(rows):
    groups: dict = {}
    for r in rows.collect():
        groups.setdefault(r.root, set()).add(r.doc_id)
    return {frozenset(g) for g in groups.values()}


def second_copies():
    """Groups of an original, copies, and copies of copies that are near their copy only."""
    rng = random.Random(3)
    rows = []
    for group in range(4):
        words = [f"g{group}w{j}" for j in range(150)]
        texts = [words]
        for _ in range(60):
            texts.append(edited(words, 0.015, rng))
        for copy in texts[1:61]:
            texts.append(edited(copy, 0.035, rng))
        rows += [(1000 * group + k, " ".join(t)) for k, t in enumerate(texts)]
    return rows


def test_second_copies_meet_members_that_have_led(docs, fresh):
    rows = second_copies()
    assert found_classes(om.classes(docs(rows), staging=fresh)) == classes_of(rows)


def test_pairs_at_exactly_the_threshold():
    for k in range(1, 500):
        short, long = np.arange(4 * k, dtype=np.uint64), np.arange(5 * k, dtype=np.uint64)
        assert om.similarity(short, long) == 0.8
