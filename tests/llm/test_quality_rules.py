from __future__ import annotations

import random
import re

from sparkmart.llm.quality_rules import RepetitionRules, keep_good, measure, repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RULES = RepetitionRules()


def brute(text):
    words = WORD.findall(text or "")
    chars = sum(map(len, words))

    def starts(n):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        return [(k, grams.index(g) < k, grams.count(g) > 1) for k, g in enumerate(grams)]

    def covered(n, which):
        return {p for row in starts(n) if row[which] for p in range(row[0], row[0] + n)}

    lines = (text or "").split("\n")
    again = [x for k, x in enumerate(lines) if WORD.search(x) and x in lines[:k]]
    dup_lines = sum(len("".join(WORD.findall(x))) for x in again)
    repeated = len(covered(8, 2))
    base = len(words) < 20 or 100 * repeated > 30 * len(words)
    dups = [sum(len(words[p]) for p in covered(n, 1)) for n in RULES.max_coverage]
    kept = not base and 100 * dup_lines <= RULES.max_line_coverage * chars
    kept = kept and all(100 * d <= m * chars for d, m in zip(dups, RULES.max_coverage.values()))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), chars, symbols, len(again), repeated, dup_lines, *dups, base, kept


def cases():
    rng = random.Random(5)
    texts = [None, "", " \n \x0b", "one", "a\xa0b c " * 30, "x " * 25, "é#ü|<> " * 3]
    for size in (15, 25, 80, 200):
        for kinds in (2, 5, 50):
            words = [rng.choice([f"w{k}é", "A", "b\x0c"][: 1 + k % 3]) + str(rng.randrange(kinds)) for k in range(size)]
            texts.append(rng.choice([" ", "\n", "  \t"]).join(words))
    line = " ".join(f"v{k}" for k in range(12))
    texts += ["\n".join([line, "other words here", line, "", line]), (line + "\n") * 9, line * 3]
    return texts


def test_against_brute_force(docs):
    rows = [(k, t) for k, t in enumerate(cases())] + [(None, "null id " * 9), (3, "one")]
    found = sorted([tuple(r) for r in repetition(docs(rows)).collect()], key=repr)
    assert found == sorted([(k, *brute(t)) for k, t in rows], key=repr)


def test_long_text_and_hash_collisions(monkeypatch):
    text = " ".join(f"w{k % 30000}" for k in range(60_000))
    assert measure([text], RULES)["n_repeat_words"][0] == 60_000
    monkeypatch.setattr("sparkmart.llm.quality_rules.mixed", lambda ids: (ids * 0).astype("uint64"))
    texts = [t or "" for t in cases()[:14]]
    found = measure(texts, RULES)  # all windows of a length collide
    assert [int(n) for n in found["n_repeat_words"]] == [brute(t)[4] for t in texts]


def test_filter_keeps_rows_whole(docs):
    good = " ".join(f"w{k}" for k in range(40))
    kept = keep_good(docs([(1, good), (2, "spam " * 50), (3, None), (1, good)]))
    assert [tuple(r) for r in kept.collect()] == [(1, good, "en", "host", 1, 2, "x", 0.5)] * 2
    assert keep_good(docs([])).count() == 0 and repetition(docs([])).count() == 0
