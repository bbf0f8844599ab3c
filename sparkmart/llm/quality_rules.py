"""Repetition coverage: how many of a text's characters lie in repeated n-grams and lines.

Words are runs of characters other than ASCII white space. For each n-gram length the windows of
all texts in a slice are hashed at once by a rolling hash in numpy (prefix sums of word hashes
times powers of an odd base, modulo 2^64); equal hashes are compared word by word before they
count. Nothing is shuffled: a text is measured where it is read.

Null and empty texts have no words; they fail the base rule (fewer than 20 words). Rows are
independent, so repeated rows and ties give repeated results, and an empty table an empty one. A
very long text is a slice of its own. Other columns, whatever their names, go no further, or stay as
they are where rows are kept (keep_good).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmart.llm.common import columns, per_slice, texts_of

SYMBOLS = re.compile(r"[#*$%&|<>]")
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
WHITE = {c: None for c in (0x20, *range(0x09, 0x0E))}
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2^64


@dataclass(frozen=True)
class RepetitionRules:
    """What a kept text may have at most.

    max_coverage: per n-gram length, percent of the characters in words that lie in occurrences
    after the first of an n-gram of that many words. max_line_coverage: the same for whole lines.
    """

    min_words: int = 20
    base_window: int = 8
    max_base_percent: int = 30
    max_coverage: dict[int, int] = field(default_factory=lambda: {5: 30, 7: 25, 10: 20, 20: 20})
    max_line_coverage: int = 30


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words (no two texts share one), characters per word, and the texts' bounds."""
    ids: list[int] = []
    chars: list[int] = []
    bounds = [0]
    for text in texts:
        known: dict[bytes, int] = {}
        first = len(chars)
        ids.extend([known.setdefault(w, first + len(known)) for w in text.encode("utf-8", "replace").split()])
        chars.extend([len(w.decode()) for w in known])
        bounds.append(len(ids))
    every = np.array(ids, dtype=np.int64)
    return every, np.array(chars, dtype=np.int64)[every], np.array(bounds, dtype=np.int64)


def mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each id."""
    x = ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Rolling hashes of the windows over one slice's words, for any window length."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        self.ids = ids
        self.ends = np.repeat(bounds[1:], np.diff(bounds))
        n = len(ids)
        powers = np.full(n + 1, np.uint64(_BASE))
        inverse = np.full(n + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
        powers[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        sums = np.cumsum(mixed(ids) * np.cumprod(powers, dtype=np.uint64)[:n], dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def repeats(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that occur again in their text: those after the first, and all."""
        none = np.zeros(0, np.int64)
        if len(self.ids) < n:
            return none, none
        starts = np.flatnonzero(self.ends[: len(self.ids) - n + 1] >= np.arange(len(self.ids) - n + 1) + n)
        if not len(starts):
            return none, none
        hashes = (self.sums[starts + n] - self.sums[starts]) * self.inverse[starts]
        order = np.argsort(hashes, kind="stable")
        hashes, starts = hashes[order], starts[order]
        same = hashes[1:] == hashes[:-1]
        a, b = starts[:-1][same], starts[1:][same]
        if not all((self.ids[a + j] == self.ids[b + j]).all() for j in range(n)):  # a collision
            rows = np.stack([self.ids[starts + j] for j in range(n)], axis=1)
            order = np.lexsort(rows.T[::-1])
            starts, rows = starts[order], rows[order]
            same = (rows[1:] == rows[:-1]).all(axis=1)
        later = np.concatenate([[False], same])
        every = later | np.concatenate([same, [False]])
        return starts[later], starts[every]

    def covered(self, starts: np.ndarray, n: int) -> np.ndarray:
        """True for the words inside a window of n words with one of these starts."""
        steps = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.subtract.at(steps, starts + n, 1)
        return np.cumsum(steps[:-1]) > 0


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over each text's words."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def measure(texts: list[str], rules: RepetitionRules) -> dict[str, np.ndarray]:
    """All figures of some texts, and the verdicts."""
    ids, chars, bounds = word_ids(texts)
    n_words, word_chars = np.diff(bounds), per_text(chars, bounds)
    windows = Windows(ids, bounds)
    out = {"n_words": n_words, "word_chars": word_chars}
    out["n_symbols"] = np.array([len(SYMBOLS.findall(t)) for t in texts], np.int64)
    dup_lines, dup_chars = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                dup_lines[k] += 1
                dup_chars[k] += len(line.translate(WHITE))
            elif HAS_WORD.search(line):
                seen.add(line)
    out["n_dup_lines"] = dup_lines
    _, every = windows.repeats(rules.base_window)
    out["n_repeat_words"] = per_text(windows.covered(every, rules.base_window), bounds)
    out["base_failed"] = (n_words < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.max_base_percent * n_words
    )
    out["dup_line_chars"] = dup_chars
    bad = out["base_failed"] | (100 * dup_chars > rules.max_line_coverage * word_chars)
    for n, percent in rules.max_coverage.items():
        later, _ = windows.repeats(n)
        out[f"dup_chars_{n}"] = per_text(chars * windows.covered(later, n), bounds)
        bad = bad | (100 * out[f"dup_chars_{n}"] > percent * word_chars)
    out["kept"] = ~bad
    return out


def repetition(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: RepetitionRules = RepetitionRules()
) -> DataFrame:
    """One row per row of docs: the id, the figures of its whole text, base_failed and kept."""
    docs = columns(docs, id_col, text_col)
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    longs += [f"dup_chars_{n}" for n in rules.max_coverage]
    names = [*longs, "base_failed", "kept"]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join(
        [f"`{id_col}` {id_type}", *[f"{c} BIGINT" for c in longs], "base_failed BOOLEAN", "kept BOOLEAN"]
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(texts_of(batch, text_col), rules)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), *[pa.array(found[c]) for c in names]], [id_col, *names]
        )

    return per_slice(docs, text_col, schema, work)


def keep_good(docs: DataFrame, text_col: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of docs, with all their columns, whose texts the rules keep."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(measure(texts_of(batch, text_col), rules)["kept"]))

    return per_slice(docs, text_col, docs.schema, work)
