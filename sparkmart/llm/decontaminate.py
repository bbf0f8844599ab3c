"""Benchmark decontamination by suffix arrays over the training texts.

Each task builds, for the texts it reads (a shard), a suffix array over words: the starts of all
suffixes that could begin with a test passage, sorted by their first words. Every suffix of the
test items is binary-searched in it; the range of suffixes that begin with its first `window` words
gives all places where it occurs, and from those that could not begin earlier the longest verbatim
matches follow, with their places in item and document. All words of such a match are hit: they are
the words of the windows of `window` consecutive item words that occur. An item of fewer words is a
window as a whole.

Nothing is shuffled: a document's words lie in one shard, and the test items go to every task in
blocks of bounded size, however many there are. Words are runs of letters, digits and non-ASCII
characters, with A-Z lower-cased. A suffix whose first words are not all words of the block
cannot match and is left out of the array.

A null or empty text has no words and no hits; a null or empty item has no window. Rows are
independent: repeated rows give repeated results, items with equal text are all named (one with a
null id is counted, not named). A very long text is a shard like others. Without items, no document
is contaminated; an empty table gives an empty one. Other columns, whatever their names, go no
further, or stay as they are where rows are kept (clean).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmart.llm.common import columns, per_slice, texts_of
from sparkmart.staging import Staging

#: Bytes that are no part of a word, once A-Z are folded: ASCII but for digits and letters. Those
#: of other characters in UTF-8 are all words'.
_APART = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

#: Characters of item texts that are sent to the tasks at once.
BLOCK_CHARS = 8 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().translate(_APART).split()  # bytes.lower() folds A-Z alone


@dataclass
class Block:
    """Test items as word numbers, one after the other, with a separator (-1) behind each."""

    items: list
    vocabulary: dict[bytes, int]
    words: np.ndarray
    starts: np.ndarray  # of the windows
    lengths: np.ndarray  # of the windows
    owners: np.ndarray  # index of the item of each window
    wanted: np.ndarray  # the words of the windows, row by row

    @classmethod
    def of(cls, rows: list[tuple], window: int) -> Block:
        vocabulary: dict[bytes, int] = {}
        words: list[int] = []
        starts, lengths, owners, items = [], [], [], []
        for item, text in rows:
            own = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text or "")]
            n = min(window, len(own))
            if n:
                for k in range(len(own) - n + 1):
                    starts.append(len(words) + k)
                    lengths.append(n)
                    owners.append(len(items))
                items.append(item)
                words += [*own, -1]
        numbers = [np.array(x, np.int64) for x in (words, starts, lengths, owners)]
        depth = max(lengths, default=0)
        padded = np.concatenate([numbers[0], np.full(depth, -1)]).astype(np.int32)
        wanted = padded[numbers[1][:, None] + np.arange(depth, dtype=np.int64)]
        return cls(items, vocabulary, *numbers, wanted)


class Shard:
    """The words of some texts and the suffix array of the suffixes that can match a block."""

    def __init__(self, texts: list[list[bytes]], block: Block, depth: int):
        self.bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.words = np.full(int(self.bounds[-1]) + depth, -2, np.int64)  # -2: ends and other words
        find = block.vocabulary.get
        for at, text in zip(self.bounds, texts):
            self.words[at : at + len(text)] = [find(w, -2) for w in text]
        n = int(self.bounds[-1])
        known = np.concatenate([self.words[:n] >= 0, [False]])
        breaks = np.flatnonzero(~known)
        runs = breaks[np.searchsorted(breaks, np.arange(n))] - np.arange(n)  # known words from here on
        least = int(block.lengths.min()) if len(block.lengths) else n + 1
        starts = np.flatnonzero(runs >= max(least, 1))
        self.order = self._sorted(starts, depth)

    def _sorted(self, starts: np.ndarray, depth: int) -> np.ndarray:
        """The starts sorted by their first depth words: a radix sort, several words to a key."""
        if not len(starts):
            return starts
        bits = max(1, int(self.words.max() + 3).bit_length())
        per_key = max(1, 62 // bits)
        keys = []
        for first in range(0, depth, per_key):
            key = np.zeros(len(starts), np.int64)
            for j in range(first, min(first + per_key, depth)):
                key = (key << bits) | (self.words[starts + j] + 2)
            keys.append(key)
        return starts[np.lexsort(keys[::-1])]

    def compare(self, at: np.ndarray, wanted: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """-1, 0, 1: how the suffixes at these starts compare with wanted, up to their lengths."""
        sign = np.zeros(len(at), np.int64)
        for j in range(wanted.shape[1]):
            open_ = (sign == 0) & (j < lengths)
            if not open_.any():
                break
            sign[open_] = np.sign(self.words[at[open_] + j] - wanted[open_, j])
        return sign

    def ranges(self, wanted: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Binary search: the ranges of the array whose suffixes begin with the wanted words."""
        found = []
        for upper in (False, True):
            low = np.zeros(len(wanted), np.int64)
            high = np.full(len(wanted), len(self.order), np.int64)
            while (todo := np.flatnonzero(low < high)).size:
                middle = (low[todo] + high[todo]) // 2
                sign = self.compare(self.order[middle], wanted[todo], lengths[todo])
                right = sign <= 0 if upper else sign < 0
                low[todo[right]] = middle[right] + 1
                high[todo[~right]] = middle[~right]
            found.append(low)
        return found[0], found[1]

    def longest(self, at: np.ndarray, block: Block, starts: np.ndarray) -> np.ndarray:
        """Words that the suffixes at these places have in common with the block's suffixes."""
        common = np.zeros(len(at), np.int64)
        todo = np.arange(len(at))
        while todo.size:
            a, b = at[todo] + common[todo], starts[todo] + common[todo]
            inside = (a < len(self.words)) & (b < len(block.words))
            same = np.zeros(len(todo), bool)
            same[inside] = (self.words[a[inside]] == block.words[b[inside]]) & (self.words[a[inside]] >= 0)
            todo = todo[same]
            common[todo] += 1
        return common


def occurrences(shard: Shard, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """All (start in the shard, window of the block) where the window occurs."""
    none = np.zeros(0, np.int64)
    if not len(shard.order) or not len(block.starts):
        return none, none
    low, high = shard.ranges(block.wanted, block.lengths)
    sizes = high - low
    which = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return shard.order[low[which] + inside], which


def longest_matches(shard: Shard, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start in the shard, start in the block, item, words) of all verbatim matches of a window and
    more that extend neither to the left nor to the right."""
    at, which = occurrences(shard, block)
    begins = block.starts[which]
    before = (at > 0) & (begins > 0)
    longer = np.zeros(len(at), bool)
    a, b = shard.words[at[before] - 1], block.words[begins[before] - 1]
    longer[before] = (a == b) & (a >= 0)
    at, which, begins = at[~longer], which[~longer], begins[~longer]
    return at, begins, block.owners[which], shard.longest(at, block, begins)


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, most_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about most_chars characters, one block at a time on the driver."""
    rows: list[tuple] = []
    size = 0
    items = columns(benchmark, id_col, text_col).dropDuplicates()
    for item, text in Staging(benchmark.sparkSession).write(items, "items")[0].toLocalIterator():
        rows.append((item, text))
        size += len(text or "") + 16
        if size >= most_chars:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


class Decontaminator:
    """The blocks of a benchmark, broadcast; they measure and filter documents."""

    def __init__(
        self,
        benchmark: DataFrame,
        item_id: str = "item_id",
        item_text: str = "text",
        window: int = 13,
        ratio: int = 20,
        block_chars: int = BLOCK_CHARS,
    ):
        """A document is contaminated if it is hit and hits times ratio reach its words."""
        context = benchmark.sparkSession.sparkContext
        self.window, self.ratio, self.name = window, ratio, uuid.uuid4().hex
        self.id_type = benchmark.schema[item_id].dataType.simpleString()
        self.blocks = [context.broadcast(b) for b in blocks_of(benchmark, item_id, item_text, block_chars)]

    def _hits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, list[set], np.ndarray]:
        """Hit words, the set of items with matches and the words of the longest match, for each text."""
        blocks, window, name = self.blocks, self.window, self.name
        bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
        hit = np.zeros(int(bounds[-1]) + 1, bool)
        items: list[set] = [set() for _ in texts]
        longest = np.zeros(len(texts), np.int64)
        for block in _loaded(blocks, window, name):
            shard = Shard(texts, block, window)
            at, _, owners, length = longest_matches(shard, block)
            steps = np.zeros(len(hit) + 1, np.int64)
            np.add.at(steps, at, 1)
            np.add.at(steps, at + length, -1)
            hit |= np.cumsum(steps[:-1]) > 0
            docs = np.searchsorted(bounds, at, side="right") - 1
            np.maximum.at(longest, docs, length)
            pairs = np.unique(np.stack([docs, owners]), axis=1)
            for doc, owner in pairs.T.tolist():
                items[doc].add(block.items[owner])
        sums = np.concatenate([[0], np.cumsum(hit)])
        return sums[bounds[1:]] - sums[bounds[:-1]], items, longest

    def _judged(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[set], np.ndarray, np.ndarray]:
        n_words = np.array([len(t) for t in texts], np.int64)
        n_hit, items, longest = self._hits(texts)
        return n_words, n_hit, items, (n_hit > 0) & (self.ratio * n_hit >= n_words), longest

    def measure(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per row of docs: words, hit words, items found, the verdict, and the number of words
        of the longest verbatim match."""
        docs = columns(docs, id_col, text_col)
        schema = (
            f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words BIGINT, n_hit BIGINT,"
            " n_items BIGINT, items_sha256 STRING, contaminated BOOLEAN, longest_match BIGINT"
        )

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, n_hit, items, bad, longest = self._judged([words_of(t) for t in texts_of(batch, text_col)])
            named = [",".join(sorted(str(i) for i in x if i is not None)) for x in items]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col), pa.array(n_words), pa.array(n_hit),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in named]), pa.array(bad),
                    pa.array(longest),
                ],
                [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"],
            )

        return per_slice(docs, text_col, schema, work)

    def matches(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The longest verbatim matches: for each place where a window occurs, item and document
        positions and the number of words in common from there on, where no longer one begins."""
        docs = columns(docs, id_col, text_col)
        doc_type = docs.schema[id_col].dataType.simpleString()
        schema = (
            f"`{id_col}` {doc_type}, item_id {self.id_type}, item_start BIGINT, doc_start BIGINT, length BIGINT"
        )

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            blocks, window, name = self.blocks, self.window, self.name
            texts = [words_of(t) for t in texts_of(batch, text_col)]
            ids = batch.column(id_col).to_pylist()
            rows = []
            for block in _loaded(blocks, window, name):
                shard = Shard(texts, block, window)
                at, begins, owner, length = longest_matches(shard, block)
                firsts = np.concatenate([[0], np.flatnonzero(block.words == -1) + 1])  # of the items
                doc = np.searchsorted(shard.bounds, at, side="right") - 1
                for d, o, s, p, n in zip(doc, owner, begins - firsts[owner], at - shard.bounds[doc], length):
                    rows.append((ids[d], block.items[o], int(s), int(p), int(n)))
            names = [id_col, "item_id", "item_start", "doc_start", "length"]
            parts = [list(x) for x in zip(*rows)] or [[] for _ in names]
            kinds = [batch.schema.field(id_col).type, None, pa.int64(), pa.int64(), pa.int64()]
            if not rows:
                kinds[1] = pa.string() if self.id_type == "string" else pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(parts, kinds)], names)

        return per_slice(docs, text_col, schema, work)

    def clean(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of docs, with all their columns, that are not contaminated."""

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bad = self._judged([words_of(t) for t in texts_of(batch, text_col)])[3]
            return batch.filter(pa.array(~bad))

        return per_slice(docs, text_col, docs.schema, work)


_PREPARED: dict[str, Block] = {}


def _loaded(blocks: list, window: int, name: str) -> Iterator[Block]:
    """The blocks in turn; a worker keeps the first, so that a single block is prepared once."""
    for k, sent in enumerate(blocks):
        block = None if k else _PREPARED.get(name)
        if block is None:
            block = Block.of(sent.value, window)
            if k == 0:
                _PREPARED.clear()
                _PREPARED[name] = block
        yield block
