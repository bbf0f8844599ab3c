from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm import prefix_trie
from sparkmart.llm.prefix_trie import build, plain_turns, reopened_turns
from sparkmart.llm.radix import AdaptiveRadixTree, Direct, Indexed, Sorted
from sparkmart.staging import Staging


def add(a, b):
    return tuple(x + y for x, y in zip(a, b))


def tree_of(keys):
    tree = AdaptiveRadixTree(add)
    for key in keys:
        tree.put(key, (1,))
    return tree


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"aa", b"ab", b"ba", b"\x00\xff", b"\xff\x00"]), max_size=5).map(b"".join), min_size=1))
def test_levels(keys):
    """Every prefix of whole turns, with the number of keys that have it."""
    expected = Counter(k[:d] for k in keys for d in range(0, len(k) + 1, 2))
    found = {}
    for key, start, (n,) in tree_of(keys).levels(0, 2):
        for d in range(0, len(key) + 1, 2):
            if d > start:
                assert key[:d] not in found
                found[key[:d]] = n
    assert found == expected


def test_layouts_grow():
    kinds = []
    for n in (1, 4, 5, 16, 17, 48, 49, 256):
        tree = tree_of(bytes([7, b, 1]) for b in range(n))
        kinds.append(type(tree.root.children) if n > 1 else None)
        if n > 1:
            assert tree.root.path == b"\x07"
            assert [b for b, _ in tree.root.children.items()] == list(range(n))
            assert all(tree.root.children.get(b).path == b"\x01" for b in range(n))
            assert n == 256 or tree.root.children.get(255) is None
    assert kinds == [None, Sorted, Sorted, Sorted, Indexed, Indexed, Direct, Direct]
    assert tree_of(bytes([7, b]) for b in range(4)).root.children.room == 4
    assert tree_of(bytes([7, b]) for b in range(5)).root.children.room == 16


def conversations_of(rows):
    """The turns of each conversation, in order."""
    found: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def reopened(found):
    result = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 4
        result[c] = found.get(c - c % 20, [])[:h] + own[h:]
    return result


def expected(found):
    members: dict = {}
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, own in members.items():
        weight = (len(own) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += weight
    return sorted(
        (
            min(own), len(path), min(members[path[:-1]]) if path else -1, len(own), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if len(found[c]) == len(path)).encode()).hexdigest(),
        )
        for path, own in members.items()
    )


def plain(nodes):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in nodes.collect())


def frame(sent, rows, parts=3):
    """With columns whose names the operator uses inside."""
    wide = [(*r, 1, "x", b"y", 4, 5) for r in rows]
    schema = "conv_id LONG, turn INT, role STRING, text STRING, place LONG, id STRING, node BINARY, block LONG, first LONG"
    return sent.createDataFrame(wide, schema).repartition(parts)


ODD = [
    (0, None, "user", "a  b"), (0, 1, None, None), (0, 1, None, None), (0, 1, "user", "x"), (0, 2, "user", "y"), (1, 1, "s", "only"),
    (2, 5, "user", "a  b"), (3, 0, "u", "same"), (3, 0, "u", "same"), (4, 0, "u\nv", "w"), (5, 0, "u", "v\nw"), (None, 1, "user", "nobody"),
    (41, 1, "user", "no leader"), (45, 1, "u", "t1"), (45, 2, "u", "t2"), (43, 1, "u", "z"), (47, 0, "", ""), (2_000_000_007, 0, "u", "far"),
]


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        opening = [("user", f"hello {k}") for k in range(rng.choice([0, 1, 2, 64, 65, 130]))]
        tail = [(rng.choice("ua"), rng.choice(["yes", "no", "a b c"])) for _ in range(rng.randrange(0, 4))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(opening + tail)]
    rows += [(200 + c, k, "u", f"copy {k}") for c in range(40) for k in range(3)]
    rows += [(300, k, "u", f"long {k % 7}") for k in range(700)]
    return rows


@pytest.mark.parametrize("rows", [ODD, random_rows(1)], ids=["odd", "random"])
def test_reopened(sent, fresh, rows):
    found = build(reopened_turns(frame(sent, rows), fresh), fresh)
    assert plain(found) == expected(reopened(conversations_of(rows)))


def test_as_they_are_in_small_trees(sent, fresh, monkeypatch):
    rows = random_rows(2)
    staging = Staging(sent, fresh.folder)
    found = build(plain_turns(frame(sent, rows, 1), staging), staging)
    assert plain(found) == expected(conversations_of(rows))


def test_trees_of_few_keys(monkeypatch):
    """Tasks that start new trees give the same sums."""
    import pyarrow as pa

    rows = [(0, prefix_trie.ROOT, bytes([k % 3]) * 20 + bytes([k % 2]) * 20, k, k, 1) for k in range(30)]
    names = ["block", "prefix", "turns", "conv_id", "saved", "leaves"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + 4]]) for k in range(0, 30, 4)]

    def sums():
        found: dict = {}
        for batch in prefix_trie._trees(iter(batches)):
            for r in batch.to_pylist():
                key = (r["node"], r["parent"], r["depth"], r["words"])
                a = found.get(key, (0, 10**9, 0, 0))
                found[key] = (a[0] + r["n"], min(a[1], r["conv_id"]), a[2] + r["saved"], a[3] + r["leaves"])
        return found

    whole = sums()
    monkeypatch.setattr(prefix_trie, "KEYS_AT_ONCE", 4)
    assert sums() == whole and len(whole) == 1 + 3 + 6


def test_one_long_text(sent, fresh):
    rows = [(1, 0, "u", "word " * 300_000), (2, 0, "u", "word " * 300_000), (3, 0, "u", None)]
    staging = Staging(sent, fresh.folder)
    found = build(plain_turns(frame(sent, rows), staging), staging)
    assert plain(found) == expected(conversations_of(rows))


def test_empty(sent, fresh):
    assert build(reopened_turns(frame(sent, []), fresh), fresh).count() == 0
