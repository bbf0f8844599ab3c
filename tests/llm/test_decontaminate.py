from __future__ import annotations

import hashlib
import random
import re

import pytest

from sparkmart.llm.decontaminate import Decontaminator, words_of
from sparkmart.llm.decontaminate_shuffled import ShuffledDecontaminator, decontaminator

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        words = plain_words(text)
        hit, named, longest = set(), set(), 0
        for item, wanted in items:
            w = plain_words(wanted)
            n = min(13, len(w))
            for k in range(len(w) - n + 1) if n else ():
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == w[k : k + n]:
                        hit |= set(range(at, at + n))
                        named.add(str(item))
                        while at + n < len(words) and k + n < len(w) and words[at + n] == w[k + n]:
                            n += 1
                        longest, n = max(longest, n), min(13, len(w))
        names = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(named), names, bool(hit) and 20 * len(hit) >= len(words), longest))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(3)
    vocabulary = ["the", "Ünd", "x1", "a", "É", "of", "in", "zu"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate((20, 13, 5, 1, 30, 14))]
    items += [(10, items[0][1]), (11, None), (12, "... !"), (None, "only of null")]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for k in range(30)]
    docs += [(100 + k, f"Before, {t}; after") for k, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "THE only, OF null"), (202, "THE only, OF null"), (None, items[1][1])]
    docs += [(203, "w " * 30_000 + items[4][1] + " w" * 30_000)]
    return docs, items


def test_words():
    text = "It's ÄÖ_x1-2\x7fé K9\x00z İ"
    assert [w.decode() for w in words_of(text)] == plain_words(text)


@pytest.mark.parametrize("block_chars", [40, 1 << 20])
def test_against_brute_force(sent, docs, block_chars):
    rows, items = cases()
    bench = sent.createDataFrame([(i, t, 1) for i, t in items], "item_id LONG, text STRING, doc_id LONG")
    found = Decontaminator(bench, block_chars=block_chars).measure(docs(rows))
    named = [(i, t) for i, t in items if i is not None]
    expected = {r[0]: r for r in brute(rows, named)}
    for row in found.collect():
        if row.doc_id not in (109, 202):  # hit by the item without an id, which is counted but not named
            assert tuple(row) == expected[row.doc_id]
    nameless = [r for r in found.collect() if r.doc_id in (109, 202)]
    assert [(r.doc_id, r.n_hit, r.contaminated) for r in sorted(nameless, key=str)] == [(109, 3, True), (202, 3, True), (202, 3, True)]
    assert all(r.n_items >= 1 for r in nameless)


def test_matches_and_clean(sent, docs):
    item = " ".join(f"w{k}" for k in range(30))
    bench = sent.createDataFrame([(7, item)], "item_id LONG, text STRING")
    rows = [(1, f"x x {' '.join(item.split()[2:22])} y"), (2, "w1 w2"), (3, None)]
    tool = Decontaminator(bench)
    assert [tuple(r) for r in tool.matches(docs(rows)).collect()] == [(1, 7, 2, 2, 20)]
    kept = tool.clean(docs(rows))
    assert kept.columns == docs(rows).columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


@pytest.mark.parametrize("bits", [28, 11])
def test_by_shuffle(sent, docs, fresh, bits):
    """The same rows as with the items in every task, also where the bitmap lets far too much through."""
    rows, items = cases()
    bench = sent.createDataFrame([(i, t, 1) for i, t in items], "item_id LONG, text STRING, doc_id LONG")
    tool = ShuffledDecontaminator(bench, filter_bits=bits, staging=fresh)
    plain = Decontaminator(bench)
    measured = [sorted(map(tuple, t.measure(docs(rows)).collect()), key=repr) for t in (tool, plain)]
    assert measured[0] == measured[1] and len(measured[0]) == len(rows)
    found = [sorted(map(tuple, t.matches(docs(rows)).collect()), key=repr) for t in (tool, plain)]
    assert found[0] == found[1] and found[0]
    kept = [sorted(map(tuple, t.clean(docs(rows)).collect()), key=repr) for t in (tool, plain)]
    assert kept[0] == kept[1] and tool.clean(docs(rows)).columns == docs(rows).columns


def test_the_size_decides(sent, docs, fresh):
    bench = sent.createDataFrame([(1, "some words of an item")], "item_id LONG, text STRING")
    assert isinstance(decontaminator(bench), Decontaminator)
    large = decontaminator(bench, broadcast_chars=5, staging=fresh)
    assert isinstance(large, ShuffledDecontaminator)
    assert [r.contaminated for r in large.measure(docs([(1, "x SOME words of an item y")])).collect()] == [True]
    assert large.measure(docs([])).count() == 0


def test_no_items_by_shuffle(sent, docs, fresh):
    none = sent.createDataFrame([], "item_id LONG, text STRING")
    tool = ShuffledDecontaminator(none, staging=fresh)
    assert sorted(tuple(r)[:4] for r in tool.measure(docs([(1, "a b"), (2, None)])).collect()) == [(1, 2, 0, 0), (2, 0, 0, 0)]


def test_empty_tables(sent, docs):
    none = sent.createDataFrame([], "item_id LONG, text STRING")
    assert [r.contaminated for r in Decontaminator(none).measure(docs([(1, "a b")])).collect()] == [False]
    assert Decontaminator(none).measure(docs([])).count() == 0
