"""Best-fit packing of tokenized documents into sequences, under several capacities at once.

A sequence has room for so many tokens, so many documents and so much attention cost (the sum of
the squared lengths of its pieces, as attention stays inside a document). Pieces are taken by
falling length; each goes to the open sequence that has room for it in every respect and is best
by the weighted norm of what would be left (or by the weighted dot product of the piece's demand
and what is left), or else opens a new one.

Documents are tokenized where they are read. Only ids, lengths and checksums are shuffled, to
shards of a bounded number of pieces by a hash of the piece, which no document, source or length
can overfill. What poorly filled sequences hold is then dealt to fewer shards and packed again.

A null or empty text is one piece, the end token alone. Every row is packed: repeated rows are
packed repeatedly, ties in length are taken by id, piece and checksum, null ids last. A very long
text is cut into pieces of a full sequence each. An empty table gives an empty one. Other columns,
whatever their names, go no further.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices, texts_of
from sparkmart.llm.spans import distinct, spans
from sparkmart.staging import Staging

WHITE = re.compile(r"[\x20\x09-\x0D]+")
#: What str.split() takes for white space and the tokenizer doesn't.
ODD = re.compile(r"[\x1C-\x1F]")
#: Beyond these characters, folding case or composing marks may depend on the library.
NOT_LATIN = re.compile(r"[^\x00-\u024F]")
#: Marks that end a word and are tokens of their own behind a letter or digit.
TAIL = ".,;:!?#*$%&|)\""
#: Words whose ids a task keeps; beyond, it starts anew.
KNOWN_WORDS = 400_000

#: Latin-1 characters with the case folded and white space made one.
FOLD = bytes(
    32 if chr(c) in "\t\n\v\f\r\x85\xa0" else ord(chr(c).lower()) for c in range(256)
)
#: Of the folded characters: white space and the end of a text 0, letters and digits 1, marks that end a word 2.
KIND = np.array(
    [0 if c in (0, 32) else 2 if chr(c) in TAIL else 1 if chr(c).isalnum() else 3 for c in range(256)], np.uint8
)


class WordCache:
    """Token ids of a text, from those of its white-space separated words, which a task keeps.

    Right for tokenizers that fold case, drop white space and never merge across it or between
    letters and marks. A word is taken as a stem and the marks behind it. Stems of Latin letters
    are encoded many at a time, folded already; the tokens that end a word tell them apart. All
    other stems go through the whole tokenizer one by one.

    Texts of Latin-1 characters, nearly all as a rule, are folded and parted from their marks many
    at a time, as bytes; only stems are looked up there, not every spelling of a word. Texts with
    other characters or with strings that the tokenizer treats specially go word by word.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(model)
        self.of_letters = Tokenizer.from_str(model)
        self.of_letters.normalizer = None
        self.of_letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.of_ascii = Tokenizer.from_str(model)  # whose letters stand for themselves in the vocabulary
        self.of_ascii.normalizer, self.of_ascii.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.special = [t.content.lower().encode("latin-1", "replace") for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def _one_by_one(self, stems: list[str]) -> list[bytes]:
        ids = []
        for k in range(0, len(stems), 1000):
            found = self.tokenizer.encode_batch_fast(stems[k : k + 1000], add_special_tokens=False)
            ids += [np.array(f.ids, "<u4").tobytes() for f in found]
        return ids

    def _of_letters(self, stems: list[str]) -> list[bytes]:
        ids: list[bytes] = []
        for k in range(0, len(stems), 1000):
            some = stems[k : k + 1000]
            joined = " ".join(some)
            tokenizer = self.of_ascii if joined.isascii() else self.of_letters
            found = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[found]) + 1)).tolist()
            if len(ends) != len(some):
                ids += self._one_by_one(some)
                continue
            packed = found.tobytes()
            ids += map(packed.__getitem__, map(slice, [0, *ends], ends))
        return ids

    def _learn(self, new: list[str]) -> None:
        """Put words into the cache."""
        if not new:
            return
        known = self.stems
        stems = [w.rstrip(TAIL) for w in new]
        joined = "\n".join(stems)
        if NOT_LATIN.search(joined) or not unicodedata.is_normalized("NFC", joined):
            latin = [not NOT_LATIN.search(s) and unicodedata.is_normalized("NFC", s) for s in stems]
            folded = [s.lower() if ok else s for s, ok in zip(stems, latin)]
            letters = [ok and s.isalpha() for s, ok in zip(folded, latin)]
        else:
            folded = joined.lower().split("\n")
            letters = [s.isalpha() for s in folded]
        odd = []
        for k, plain in enumerate(letters):
            if not plain:
                odd.append(k)
                if not stems[k].lower()[-1:].isalnum():  # what is left isn't a stem with marks behind it
                    stems[k] = new[k]
                folded[k] = stems[k]
        plain = list({s for s, plain in zip(folded, letters) if plain and s not in known})
        known.update(zip(plain, self._of_letters(plain)))
        ending = [k for k, (w, s) in enumerate(zip(new, stems)) if len(w) > len(s)]
        tails = [new[k][len(stems[k]) :] for k in ending]
        others = [s for s in {folded[k] for k in odd} | set(tails) if s not in known]
        known.update(zip(others, self._one_by_one(others)))
        known[""] = b""
        ids = [known[f] for f in folded]
        for k, tail in zip(ending, tails):
            ids[k] += known[tail]
        self.words.update(zip(new, ids))

    def forget(self) -> None:
        self.words: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if max(len(self.words), len(self.stems), len(self.parts)) > KNOWN_WORDS:
            self.forget()
        found: list[bytes] = [b""] * len(texts)
        plain, numbers, others = [], [], []
        for k, text in enumerate(texts):
            try:
                folded = text.encode("latin-1").translate(FOLD)
            except UnicodeEncodeError:
                others.append(k)
                continue
            if b"\x00" in folded or any(s in folded for s in self.special):
                others.append(k)
            else:
                plain.append(folded)
                numbers.append(k)
        if plain:
            for k, ids in zip(numbers, self._latin(plain)):
                found[k] = ids
        if others:
            for k, ids in zip(others, self._by_words([texts[k] for k in others])):
                found[k] = ids
        return found

    def _latin(self, folded: list[bytes]) -> list[bytes]:
        """The ids of texts of Latin-1 characters, folded, without null characters."""
        texts = np.frombuffer(b"\x00" + b"\x00".join(folded) + b"\x00", np.uint8)
        kind = KIND[texts]
        first, stop = spans(kind == 2)
        behind = first[(kind[first - 1] == 1) & (kind[stop] == 0)]  # between a stem and white space
        texts = np.insert(texts, behind, 32)
        starts, ends = spans((texts != 0) & (texts != 32))
        some, part = distinct(texts, starts, ends)
        whole = texts.tobytes()
        parts = [whole[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())]
        known = self.parts
        new = [p for p in parts if p not in known]
        self._learn_parts(new)
        ids = [known[p] for p in parts]
        for p in new:
            if len(p) > 64:  # rare, and they would fill the memory
                known.pop(p, None)
        pool = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2  # of ids, as are all counts below
        offset = (np.cumsum(size) - size)[part]
        size = size[part]
        stops = np.cumsum(size)
        found = pool[np.repeat(offset - (stops - size), size) + np.arange(size.sum())].tobytes()
        before = np.append(0, stops)[np.searchsorted(starts, np.flatnonzero(texts == 0))]
        return [found[4 * a : 4 * b] for a, b in zip(before.tolist(), before[1:].tolist())]

    def _learn_parts(self, new: list[bytes]) -> None:
        if not new:
            return
        named = b" ".join(new).decode("latin-1").split(" ")
        letters = np.fromiter(map(str.isalpha, named), bool, len(named))
        plain = np.fromiter(map(str.isascii, named), bool, len(named))
        for encode, kind in (
            (self._of_letters, letters & plain), (self._of_letters, letters & ~plain), (self._one_by_one, ~letters)
        ):
            some = list(compress(named, kind.tolist()))
            self.parts.update(zip(compress(new, kind.tolist()), encode(some)))

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [WHITE.split(t) if ODD.search(t) else t.split() for t in texts]
        words = self.words
        new = list(set().union(*split).difference(words))
        self._learn(new)
        found = [b"".join(map(words.__getitem__, some)) for some in split]
        for word in [w for w in new if len(w) > 64]:  # rare, and they would fill the memory
            del words[word]
            for part in (word, word.rstrip(TAIL), word.rstrip(TAIL).lower()):
                self.stems.pop(part, None)
        return found


_CACHES: dict[int, WordCache] = {}


def encoded(
    batches: Iterator[pa.RecordBatch], model: Broadcast, text_col: str
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Inside a task: slices of its rows, each with the ids of its texts."""
    if 0 not in _CACHES:
        _CACHES[0] = WordCache(model.value)
    for batch in batches:
        for part in slices(batch, text_col, 3 << 20):
            yield part, _CACHES[0].encode(texts_of(part, text_col))
    _CACHES[0].forget()  # the worker goes on to other tasks, of any kind


def tokenized(
    docs: DataFrame,
    model: Broadcast,
    length: int,
    end: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of at most length tokens of all documents, each document with its end token.

    model is the tokenizer's file as text. with_ids adds the ids, for writing the sequences.
    """
    docs = columns(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
    schema += ", ids BINARY" if with_ids else ""
    last, step = np.array([end], "<u4").tobytes(), 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in encoded(batches, model, text_col):
            rows, owner = [], []
            for k, ids in enumerate(texts):
                ids += last
                for n, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at : at + step]
                    owner.append(k)
                    rows.append((n, at // 4, len(piece) // 4, zlib.crc32(piece), piece))
            named = list(zip(*rows))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [part.column(id_col).take(pa.array(owner, pa.int64()))]
            arrays += [pa.array(x, t) for x, t in zip(named, kinds)][: 5 if with_ids else 4]
            names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most, the weights of the three, and the rule of choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    by: str = "norm"  # or "dot"


def best_fit(lengths: np.ndarray, room: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the place in it for pieces that come by falling length."""
    most = np.array([room.tokens, room.documents, room.attention], np.int64)
    scale = np.sqrt(np.array(room.weights)) / most
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((3, 1024), np.int64)  # of the open sequences, by dimension
    names = np.zeros(1024, np.int64)
    n_open = n_all = 0
    least = int(lengths[-1]) if len(lengths) else 0
    for k, length in enumerate(lengths.tolist()):
        need = np.array([length, 1, length * length], np.int64)
        best = -1
        if n_open:
            rest = left[:, :n_open] - need[:, None]
            fits = np.flatnonzero((rest >= 0).all(axis=0))
            if len(fits):
                if room.by == "norm":
                    after = rest[:, fits] * scale[:, None]
                    best = fits[np.argmin((after * after).sum(axis=0))]
                else:
                    before = left[:, fits] * scale[:, None]
                    best = fits[np.argmax((before * (need * scale)[:, None]).sum(axis=0))]
        if best < 0:
            if (need > most).any():
                raise ValueError(f"a piece of {length} tokens fits no sequence")
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.zeros_like(left)], axis=1)
                names = np.concatenate([names, np.zeros_like(names)])
            best, names[n_open], left[:, n_open] = n_open, n_all, most
            n_open, n_all = n_open + 1, n_all + 1
        sequence[k] = names[best]
        offset[k] = room.tokens - left[0, best]
        left[:, best] -= need
        if left[0, best] < least or left[1, best] < 1:  # nothing that comes fits any more
            n_open -= 1
            left[:, best], names[best] = left[:, n_open], names[n_open]
    return sequence, offset


def pack(
    pieces: DataFrame,
    room: Capacities = Capacities(),
    per_shard: int = 16_384,
    well_filled: float = 0.995,
    rounds: int = 3,
    staging: Staging | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """pieces (from tokenized) with sequence_id and offset; offsets of a sequence have no gaps.

    Each round packs shards of about per_shard pieces. What lies in sequences that are filled to
    less than well_filled goes to the next round, where the shards mix what the last one left.
    """
    staging = staging or Staging(pieces.sparkSession)
    pieces, seen = staging.write(pieces, "pieces", {"n": F.count(F.lit(1))})
    names = pieces.columns
    schema = f"{pieces.schema.simpleString()[7:-1]}, sequence_id BIGINT, offset BIGINT, _fill BIGINT"
    done, count = [], seen["n"]
    for turn in range(rounds):
        shards = max(1, -(-count // per_shard))
        dealt = F.pmod(F.xxhash64(F.lit(turn), id_col, "piece", "ids_crc32"), F.lit(shards)).cast("long")
        packed = pieces.withColumn("_shard", dealt).groupBy("_shard").applyInArrow(
            _shard_packer(names, id_col, room, turn << 56), schema
        )
        good = F.col("_fill") >= int(well_filled * room.tokens)
        packed, seen = staging.write(packed, f"packed-{turn}", {"n": F.coalesce(F.count_if(~good), F.lit(0))})
        if turn == rounds - 1 or shards == 1 or not seen["n"]:
            done.append(packed)
            break
        done.append(packed.where(good))
        pieces, count = packed.where(~good).select(*names), seen["n"]
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("_fill")


def _shard_packer(names: list[str], id_col: str, room: Capacities, first_name: int):
    order = [("length", "descending"), (id_col, "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]

    def pack_shard(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        lengths = table.column("length").to_numpy()
        sequence, offset = best_fit(lengths, room)
        fill = np.bincount(sequence, weights=lengths).astype(np.int64)[sequence]
        found = table.select(names)
        name = first_name + (key[0].as_py() << 24) + sequence
        for column, values in (("sequence_id", name), ("offset", offset), ("_fill", fill)):
            found = found.append_column(column, pa.array(values, pa.int64()))
        return found

    return pack_shard
