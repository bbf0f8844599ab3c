from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import phrases, spans
from sparkmart.llm.phrases import collocations, frequent_phrases

A_TO_Z = {c: c + 32 for c in range(65, 91)}


def pieces_of(text):
    folded = (text or "").translate(A_TO_Z)
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def counted(rows, most=3):
    """f of every phrase and the number of words, per language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for words in pieces_of(text):
            n[lang] += len(words)
            for size in range(1, most + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return f, n


def expected(rows, most=3, least=10, first=2000):
    f, n = counted(rows, most)
    found: dict = {}
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least:
            continue
        if any(
            100 * other >= 50 * a
            for (l2, longer), other in f.items()
            if l2 == lang and other >= least and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        ):
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    result = []
    for lang, own in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:first], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def some_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["new", "York", "été", "a", "b.", "c!", "日本", "x-y", "\x0c", "of", "the", "city", "z" * 300, "z" * 299 + "y", "nul\x00"]
    rows = [(rng.choice(["en", "fr", None, ""]), " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for _ in range(n)]
    rows += [("en", "New\t York   city of  the"), ("en", "new York\ncity"), (None, None), ("de", ""), ("de", None)]
    rows += [("en", "hot phrase here. " * 200)] * 3
    return rows


def frame(sent, rows, parts):
    """With columns whose names the operator uses inside."""
    wide = [(*r, 1, "x", 2, 3) for r in rows]
    schema = "lang STRING, text STRING, shard INT, phrase STRING, f LONG, size INT"
    return sent.createDataFrame(wide, schema).repartition(parts)


def plain(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("parts,shards,bits", [(1, 4, 28), (6, 4, 28), (6, 9, 12), (3, 1, 10)])
def test_against_brute_force(sent, fresh, parts, shards, bits):
    rows = some_rows(parts)
    table = frequent_phrases(frame(sent, rows, parts), shards=shards, filter_bits=bits, staging=fresh)
    f, n = counted(rows)
    found = {(r.lang, r.phrase): r.f for r in table.collect()}
    assert found == {(lang, " ".join(w)): a for (lang, w), a in f.items() if a >= 10} | {(lang, ""): a for lang, a in n.items()}
    assert plain(collocations(table)) == expected(rows)
    assert plain(collocations(table, first=3)) == expected(rows, first=3)


def test_longer_phrases(sent, fresh):
    rows = some_rows(7, 60)
    table = frequent_phrases(frame(sent, rows, 2), most=4, min_count=5, staging=fresh)
    assert plain(collocations(table, most=4)) == expected(rows, 4, 5)


def test_every_hash_alike(sent, fresh):
    """Hash collisions cost time, nothing else: with all hashes equal, phrases are told apart by bytes."""
    rows = some_rows(3, 20)
    texts = np.frombuffer(b"aa bb aa cc aa bb", np.uint8)
    starts, ends = spans.spans(texts != 32)
    first, group = spans.distinct(texts, starts, ends, np.zeros(len(starts), np.uint64))
    assert [texts[starts[f] : ends[f]].tobytes() for f in first[group]] == b"aa bb aa cc aa bb".split()
    assert len(first) == 3
    assert phrases.suffix_differs(np.array([0, 1, 1]), np.array([0, 2]), np.array([0, 0, 1]), [b"en", b"fr"])
    some, sums, ends = phrases._merged(np.zeros(4, np.uint64), np.array([1, 2, 3, 4]), [b"x\na", b"yy\na", b"x\na", b"yy\na"])
    assert some.tolist() == [0, 1] and sums.tolist() == [4, 6] and ends.tolist() == [3, 7, 10, 14]
    table = frequent_phrases(frame(sent, rows, 2), filter_bits=3, staging=fresh)  # a bitmap that lets all through
    assert plain(collocations(table)) == expected(rows)


def test_products_beyond_64_bits(sent, fresh):
    big = 3_000_000_000_001
    rows = [("en", "a b", 2, big), ("en", "a", 1, big + 5), ("en", "b", 1, big + 7), ("en", "", 0, 9 * big)]
    table = sent.createDataFrame(rows, "lang STRING, phrase STRING, size INT, f LONG")
    score = 1_000_000 * big * big // ((big + 5) * (big + 7))
    assert plain(collocations(table)) == [("en", 1, "a b", big, big + 5, big + 7, 9 * big, score)]


def test_tasks_that_send_early(monkeypatch):
    """However little a task holds, the sums are the same."""
    import pyarrow as pa

    rows = [(lang, text) for lang, text in some_rows(11, 80)]
    batch = pa.RecordBatch.from_pylist([{"lang": lang, "text": t} for lang, t in rows], pa.schema([("lang", pa.string()), ("text", pa.string())]))

    class Sent:
        value = np.full(1 << 7, 255, np.uint8).tobytes()

    def summed():
        sent_on = pa.Table.from_batches(list(phrases._count(3, Sent, 10, 4)(iter([batch]))))
        found = {}
        for r in set(sent_on.column("range").to_pylist()):
            mine = sent_on.filter(pa.array([x == r for x in sent_on.column("range").to_pylist()]))
            for e in phrases._sum_up(10)((pa.scalar(r),), mine).to_pylist():
                assert (e["lang"], e["phrase"]) not in found
                found[e["lang"], e["phrase"]] = e["f"]
        return sent_on.num_rows, found

    n, whole = summed()
    f, words = counted(rows)
    assert whole == {(lang, " ".join(w)): a for (lang, w), a in f.items() if a >= 10} | {(lang, ""): a for lang, a in words.items()}
    monkeypatch.setattr(phrases, "BYTES_AT_ONCE", 500)
    monkeypatch.setattr(phrases, "ENTRIES_AT_ONCE", 40)
    more, again = summed()
    assert again == whole and more > n


def test_empty(sent, fresh):
    table = frequent_phrases(frame(sent, [], 1), staging=fresh)
    assert table.count() == 0 and collocations(table).count() == 0


def test_long_text_in_parts(sent, fresh, monkeypatch):
    text = "alpha beta gamma, delta\nepsilon " * 20_000
    whole = list(phrases._parts(text.encode()))
    assert whole == [text.encode()]
    monkeypatch.setattr(phrases, "BYTES_AT_ONCE", 1000)
    parts = list(phrases._parts(text.translate({44: 10}).encode()))
    assert len(parts) > 400 and b"".join(parts) == text.translate({44: 10}).encode()
    assert all(p.endswith(b"\n") for p in parts[:-1])
    monkeypatch.undo()
    rows = [("en", text), ("en", "alpha beta")]
    table = frequent_phrases(frame(sent, rows, 1), staging=fresh)
    assert plain(collocations(table)) == expected(rows)


def test_hashes_of_words():
    words = [b"a", b"b", b"12345678", b"123456789", b"x" * 255, b"x" * 256, b"x" * 257, b"x" * 1000, b"x" * 999 + b"y"] * 2
    texts = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends = spans.spans(texts != 32)
    keys = spans.hashes(texts, starts, ends)
    assert len(set(keys.tolist())) == 9 and (keys[:9] == keys[9:]).all()
    shifted = np.frombuffer(b"  . " + b" ".join(words), np.uint8)
    starts, ends = spans.spans(shifted != 32)
    assert (spans.hashes(shifted, starts, ends)[1:] == keys).all()
    assert spans.distinct(shifted, starts, ends)[1].max() == 9
