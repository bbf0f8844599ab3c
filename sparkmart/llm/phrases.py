"""Phrases whose words occur together more often than they would by chance, by SON partitioning.

The corpus is dealt into a few shards, each of many tasks. Pass one mines every shard completely:
all phrases of one word and more are counted per task, by a 64-bit hash of language and words, the
counts of a shard are summed, and what reaches the local support, the global one divided by the
number of shards, is a candidate. A phrase with the global support has the local one in a shard at
least, so none is lost. The union of the shards' candidates is a bitmap over the first bits of the
hashes, of a fixed size. Pass two counts every phrase that the bitmap lets through, by its words and
over all documents; what falls short of the global support, hash collisions included, is dropped
then, so the bitmap's size decides how much pass two shuffles and nothing else.

Each task sums its counts before it shuffles them, so a frequent word or a language with most of
the documents is one entry per task and phrase. Entries are shuffled in sorted runs, one row per
task and range of hashes, and merged by range; equal hashes of pass two are told apart by the words.

A null text is empty, a null language is `und`. Empty texts and tables have no phrases. Repeated
rows count repeatedly. Ties in score go by frequency, then by the phrase's bytes. A very long text
is worked on in parts that end where pieces end. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices
from sparkmart.llm.spans import distinct, hashes, mixed, spans
from sparkmart.staging import Staging

NO_LANGUAGE = "und"
#: A-Z lower-cased, the marks and line ends that part pieces made one, tab made a space.
FOLD = bytes(
    10 if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text worked on at a time; hashes, and entries with their words, that a task sums up at once.
BYTES_AT_ONCE, HASHES_AT_ONCE, ENTRIES_AT_ONCE = 2 << 20, 2_000_000, 500_000
#: Bytes of text behind one range of hashes: what a task has to merge at a time.
BYTES_PER_RANGE = 2 << 20


class Words:
    """The words of some texts, each with its place, hash, piece and language."""

    def __init__(self, folded: bytes, languages: np.ndarray, sizes: np.ndarray):
        """sizes are the bytes of the texts in folded, a line end behind each included; languages
        are their hashes."""
        texts = np.frombuffer(folded, np.uint8)
        white = texts == 32
        twice = np.zeros(len(texts), bool)
        twice[1:] = white[1:] & white[:-1]
        owner_ends = np.cumsum(sizes)
        if twice.any():  # a phrase's words are a single space apart
            owner_ends = owner_ends - np.cumsum(twice)[owner_ends - 1]
            texts, white = texts[~twice], white[~twice]
        self.texts = texts
        breaks = texts == 10
        self.starts, self.ends = spans(~(white | breaks))
        self.piece = np.cumsum(breaks, dtype=np.int32)[self.starts]
        self.owner = np.searchsorted(owner_ends, self.starts, side="right")
        self.own = hashes(texts, self.starts, self.ends)
        self.language = languages[self.owner]

    def phrases(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first word, hash) of all phrases of 1 to most words."""
        here = np.arange(len(self.starts))
        key = mixed(self.own + self.language)
        for size in range(1, most + 1):
            if size > 1:
                last = here + size - 1
                inside = last < len(self.starts)
                here, key, last = here[inside], key[inside], last[inside]
                whole = self.piece[here] == self.piece[last]
                here, key, last = here[whole], key[whole], last[whole]
                key = mixed(key * STEP + self.own[last])
            yield size, here, key


def _parts(folded: bytes) -> Iterator[bytes]:
    """A text in parts of about BYTES_AT_ONCE, each up to the end of a piece."""
    at = 0
    while len(folded) - at > BYTES_AT_ONCE:
        stop = folded.find(b"\n", at + BYTES_AT_ONCE) + 1
        if not stop:
            break
        yield folded[at:stop]
        at = stop
    yield folded[at:]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """The words of slices of (lang, text) rows, and the languages of the texts."""
    for batch in batches:
        for part in slices(batch, batch.schema.names[1], BYTES_AT_ONCE):
            named = [NO_LANGUAGE if x is None else x for x in part.column(0).to_pylist()]
            folded = [((t or "") + "\n").encode().translate(FOLD) for t in part.column(1).to_pylist()]
            if len(folded) == 1:
                for piece in _parts(folded[0]):
                    yield _of([piece], named), named
            else:
                yield _of(folded, named), named


def _of(folded: list[bytes], named: list[str]) -> Words:
    codes = {name: _code(name.encode()) for name in set(named)}
    languages = np.array([codes[n] for n in named], np.uint64)
    return Words(b"".join(folded), languages, np.array([len(f) for f in folded], np.int64))


def _code(name: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little")


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, first all lowest ones, then all second ones ..., which compresses well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _ranges(key: np.ndarray, range_bits: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of the sorted keys, for each range that has some."""
    if not range_bits:
        yield from [(0, 0, len(key))] if len(key) else []
        return
    number = key >> np.uint64(64 - range_bits)
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(key) else np.zeros(0, np.int64)
    yield from zip(number[first].tolist(), first.tolist(), [*first[1:].tolist(), len(key)])


def _gaps(key: np.ndarray) -> bytes:
    gaps = key.copy()
    gaps[1:] -= key[:-1]
    return _planes(gaps)


def _keys(planes: bytes) -> np.ndarray:
    return np.cumsum(_numbers(planes, "<u8"), dtype=np.uint64)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows, whose last fields are bytes, in batches of about `most` bytes."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


MINED = (["shard", "range", "hashes", "counts"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])
COUNTED = (["range", "hashes", "counts", "sizes", "texts"], [pa.int64(), *[pa.binary()] * 4])


def _mine(most: int, shards: int, range_bits: int):
    """Tasks of pass one: the counts of all hashes, in rows of (shard, range, hashes, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        raw: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def settle() -> None:
            whole = np.concatenate(raw)
            raw.clear()
            whole.sort()
            first = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
            keys.append(whole[first])
            counts.append(np.diff(np.append(first, len(whole))).astype(np.uint32))

        def rows() -> Iterator[pa.RecordBatch]:
            key, count = _summed(keys, counts)
            keys.clear()
            counts.clear()
            found = ((shard, r, _gaps(key[a:b]), _planes(count[a:b].astype(np.uint32))) for r, a, b in _ranges(key, range_bits))
            yield from _batches(found, *MINED)

        for words, _ in _words(batches):
            raw.extend(key for _, _, key in words.phrases(most) if len(key))
            if sum(map(len, raw)) >= HASHES_AT_ONCE:
                settle()
                if sum(map(len, keys)) >= HASHES_AT_ONCE:
                    yield from rows()
        if raw:
            settle()
        if keys:
            yield from rows()

    return run


def _frequent(range_bits: int, filter_bits: int, support: int):
    """Groups of pass one: the part of the bitmap that a range of hashes covers."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        bits = np.zeros(1 << (filter_bits - range_bits), bool)
        shard = table.column("shard").to_numpy()
        hashed, counted = table.column("hashes"), table.column("counts")
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s).tolist()
            counts = [_numbers(counted[k].as_py(), "<u4").astype(np.int64) for k in mine]
            keys, counts = _summed([_keys(hashed[k].as_py()) for k in mine], counts)
            places = keys[counts >= support] >> np.uint64(64 - filter_bits)
            bits[places - np.uint64(number << (filter_bits - range_bits))] = True
        segment = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"range": pa.array([number], pa.int64()), "bits": pa.array([segment], pa.binary())})

    return merge


def range_bits_of(texts: DataFrame, most: int) -> int:
    """The bits of a hash that name its range: one range for each BYTES_PER_RANGE of text."""
    size = texts.agg(F.sum(F.octet_length(F.col(texts.columns[1])))).first()[0] or 0
    return min(max(0, (size // BYTES_PER_RANGE).bit_length()), most)


def candidates(texts: DataFrame, most: int, min_count: int, shards: int, filter_bits: int, range_bits: int) -> np.ndarray:
    """The bitmap of the hashes that have the local support in a shard. texts is (lang, text)."""
    mined = texts.mapInArrow(_mine(most, shards, range_bits), "shard INT, `range` BIGINT, hashes BINARY, counts BINARY")
    merge = _frequent(range_bits, filter_bits, -(-min_count // shards))
    found = mined.groupBy("range").applyInArrow(merge, "`range` BIGINT, bits BINARY")
    bitmap = np.zeros(1 << (filter_bits - 3), np.uint8)
    width = len(bitmap) >> range_bits
    for row in found.collect():  # in all as many bits as the bitmap has
        bitmap[row["range"] * width : (row["range"] + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def _merged(keys: np.ndarray, counts: np.ndarray, texts: list[bytes] | bytes, sizes: np.ndarray | None = None):
    """Entries with equal words made one: the first place of each, its sum, and where all texts end."""
    blob = np.frombuffer(b"".join(texts) if isinstance(texts, list) else texts, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) if sizes is None else sizes
    ends = np.cumsum(sizes)
    some, group = distinct(blob, ends - sizes, ends, keys)
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], np.arange(len(some)))
    return some, np.add.reduceat(counts[order], first) if len(some) else counts, ends


def _count(most: int, bitmap: Broadcast, filter_bits: int, range_bits: int):
    """Tasks of pass two: the candidates' counts, in rows of (range, hashes, counts, sizes, texts).

    A text is the words, a line end, which no word has, and the language. The words of a language
    in all stand under no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        texts: list[bytes] = []

        def rows() -> Iterator[pa.RecordBatch]:
            key = np.concatenate(keys)
            some, count, _ = _merged(key, np.concatenate(counts), texts)
            order = np.argsort(key[some])
            some, count, key = some[order], count[order], key[some][order]
            own = [texts[k] for k in some.tolist()]
            sizes = np.fromiter(map(len, own), np.uint32, len(own))
            for held in (keys, counts, texts):
                held.clear()
            found = (
                (r, _gaps(key[a:b]), _planes(count[a:b]), _planes(sizes[a:b]), b"".join(own[a:b]))
                for r, a, b in _ranges(key, range_bits)
            )
            yield from _batches(found, *COUNTED)

        for words, named in _words(batches):
            picked = []
            for size, first, key in words.phrases(most):
                place = key >> np.uint64(64 - filter_bits)
                let = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0
                picked.append((first[let], key[let], np.full(int(let.sum()), size)))
            first, key, size = (np.concatenate(x) for x in zip(*picked))
            starts, ends = words.starts[first], words.ends[first + size - 1]
            whole, suffix = words.texts.tobytes(), [b"\n" + n.encode() for n in named]
            owners = words.owner[first]
            some, group = distinct(words.texts, starts, ends, key)
            if suffix_differs(owners, some, group, suffix):
                some = group = np.arange(len(key))
            texts.extend(
                whole[a:b] + suffix[o] for a, b, o in zip(starts[some].tolist(), ends[some].tolist(), owners[some].tolist())
            )
            keys.append(key[some])
            counts.append(np.bincount(group, minlength=len(some)))
            totals: dict[bytes, int] = {}
            for own, n in zip(suffix, np.bincount(words.owner, minlength=len(named)).tolist()):
                totals[own] = totals.get(own, 0) + n
            texts.extend(totals)
            keys.append(np.array([_code(t) for t in totals], np.uint64))
            counts.append(np.array(list(totals.values()), np.int64))
            if len(texts) >= ENTRIES_AT_ONCE:
                yield from rows()
        if texts:
            yield from rows()

    return run


def suffix_differs(owners: np.ndarray, some: np.ndarray, group: np.ndarray, suffix: list[bytes]) -> bool:
    """Whether spans that were taken for one belong to texts of different languages: the hashes
    hold the language, so that is a collision."""
    number = {s: k for k, s in enumerate(dict.fromkeys(suffix))}
    language = np.array([number[s] for s in suffix], np.int64)[owners]
    return bool((language != language[some][group]).any())


def _sum_up(min_count: int):
    """Groups of pass two: (lang, phrase, size, f) of what has the global support."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.concatenate([_keys(x.as_py()) for x in table.column("hashes")])
        counts = np.concatenate([_numbers(x.as_py(), "<i8") for x in table.column("counts")])
        sizes = np.concatenate([_numbers(x.as_py(), "<u4") for x in table.column("sizes")]).astype(np.int64)
        blob = b"".join(x.as_py() for x in table.column("texts"))
        some, count, ends = _merged(keys, counts, blob, sizes)
        held = (count >= min_count) | (np.frombuffer(blob, np.uint8)[ends[some] - sizes[some]] == 10)
        rows = []
        for k, f in zip(some[held].tolist(), count[held].tolist()):
            phrase, lang = blob[ends[k] - sizes[k] : ends[k]].split(b"\n", 1)
            rows.append((lang.decode(), phrase.decode(), phrase.count(b" ") + 1 if phrase else 0, f))
        values = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        return pa.table([pa.array(x, k) for x, k in zip(values, kinds)], ["lang", "phrase", "size", "f"])

    return merge


def frequent_phrases(
    docs: DataFrame,
    most: int = 3,
    min_count: int = 10,
    shards: int = 4,
    filter_bits: int = 28,
    staging: Staging | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, phrase, size, f): all phrases of 1 to most words that a language has min_count times,
    with their exact numbers; the words of each language in all under the empty phrase. Staged.

    filter_bits is the size of the bitmap: 32 MB on each executor and on the driver by default.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    texts = columns(docs, lang_col, text_col)
    range_bits = range_bits_of(texts, filter_bits - 3)
    bitmap = candidates(texts, most, min_count, shards, filter_bits, range_bits)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())
    schema = "`range` BIGINT, hashes BINARY, counts BINARY, sizes BINARY, texts BINARY"
    counted = texts.mapInArrow(_count(most, shared, filter_bits, range_bits), schema)
    summed = counted.groupBy("range").applyInArrow(_sum_up(min_count), "lang STRING, phrase STRING, size INT, f BIGINT")
    return staging.write(summed, "phrases")[0]


def _words_of(phrase: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact for counts below 10^16, an error beyond."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    squared = (a * a).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", squared.cast("decimal(38,0)"), (left * right).cast("decimal(38,0)"))


def collocations(
    counted: DataFrame,
    most: int = 3,
    first: int = 2000,
    absorbed_percent: int = 50,
    salts: int = 64,
) -> DataFrame:
    """The best phrases of each language from frequent_phrases: (lang, rank, phrase, a, l, r, n, score).

    A phrase is scored at its weakest cut, and goes if a longer one accounts for absorbed_percent of
    its occurrences.
    """
    phrases = counted.where("size > 0")
    longer = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = longer.select("lang", "phrase", "size", "a", cut)
    left = _words_of(F.col("phrase"), F.lit(1), F.col("k"))
    right = _words_of(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k"))
    sides = F.explode(F.array(F.struct(F.lit(True).alias("first"), left.alias("part")), F.struct(F.lit(False).alias("first"), right.alias("part"))))
    asked = cuts.select("lang", "phrase", "a", "k", sides.alias("side")).select("lang", "phrase", "a", "k", "side.*")
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    met = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(
        *[F.max(F.when((F.col("k") == k) & (F.col("first") == side), F.col("f"))).alias(f"_{name}{k}")
          for k in range(1, most) for side, name in ((True, "l"), (False, "r"))]
    )
    scored = [
        F.when(F.col(f"_l{k}").isNotNull(), F.struct(
            _score(F.col("a"), F.col(f"_l{k}"), F.col(f"_r{k}")).alias("score"), F.lit(k).alias("k"),
            F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r")))
        for k in range(1, most)
    ]
    weakest = met.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*scored))).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, n), ' '))))"
    )
    around = longer.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    stand = weakest.join(around, ["lang", "phrase"], "left").where(
        F.col("f").isNull() | (100 * F.col("f") < absorbed_percent * F.col("a"))
    )
    # The best of each salt first, so that no language is sorted in one task.
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    flat = stand.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    flat = flat.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    rank = F.row_number().over
    best = flat.withColumn("rank", rank(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= first)
    best = best.withColumn("rank", rank(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    totals = counted.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
