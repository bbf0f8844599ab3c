"""Near-duplicates by order MinHash, verified by banded alignment.

A text is its sequence of shingles of five words. For each of several hash functions, order
MinHash takes the few smallest occurrence-labelled shingles and keeps them in text order; two
texts agree on such a sketch about as often as they share shingles in the same order. Texts that
agree on a sketch are a bucket.

Two texts are linked if they align: with S shingles matched in order, S / (a + b - S) must reach
the threshold, a and b being their numbers of shingles. The alignment is a longest common
subsequence inside the band of diagonals that this similarity allows, taken bit-parallel.

Equal texts are one text from the start. In a bucket, all members are compared with its leader,
not with each other: that is linear in its size. The leader is the member whose buckets hold most
texts, as an original's do among its copies. Buckets with several classes are looked at again:
their members are put into finer buckets, of two sketches together, led first as before and then
by the members that no leader aligned with. That only saves work: all texts of the coarse buckets
that hold several classes then still meet each text of another class that they may align with. The
shingles of a text are put in one order for all texts, rare ones first; texts at the threshold
share one of those that come before the last 80 % (a prefix filter, which loses no pair).
Classes are the connected components, found by alternating star contractions on staged edges.
Nothing but counts comes to the driver.

What is staged goes as soon as it has been read. Links that a round finds are contracted by
themselves, between the roots that they join; the classes of the rounds before are only renamed.

A null text is empty; texts without words are linked to equal ones only, texts of fewer than five
words are one shingle. The class is named by its smallest doc_id (null if it has none but null).
Repeated rows are in one class; an empty table gives an empty one. Of members of equal weight the
one with the smallest key leads; of equal shares with the threshold, that of just the threshold
counts. A very long text is aligned inside its band like others. Other columns, whatever their
names, go no further, or stay as they are where rows are kept (one_of_each).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices, texts_of
from sparkmart.llm.decontaminate import words_of
from sparkmart.staging import Staging

SHINGLE = 5
THRESHOLD = 0.8
#: Sketches per text and shingles per sketch: of texts at the threshold, 1 in 100,000 share none.
SKETCHES, TAKEN = 16, 3
#: Keys of texts (16 bytes) up to this number are broadcast to fetch the texts.
BROADCAST_KEYS = 1_000_000
#: Sketches that together make a finer bucket.
PAIRED = [(i, (i + a) % SKETCHES) for a in (1, 3, 7) for i in range(SKETCHES)]
#: Rounds with one new leader per finer bucket, before texts of different classes are compared.
SINGLE_ROUNDS = 2
#: Bits of a shingle's hash that name the slot it is counted in. Counts only put shingles in order.
SLOT_BITS = 20


def text_key(text: Column) -> Column:
    """What identifies a text: its MD5, 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


_SEEDS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_WORDS: dict[bytes, int] = {}


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per shingle, in text order."""
    known = _WORDS
    if len(known) > 100_000:
        known.clear()
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh64_intdigest(word) - (1 << 63)  # fits a signed number
    hashes = np.array([known[w] for w in words], np.int64).view(np.uint64)
    n = min(SHINGLE, len(words))
    if not n:
        return hashes
    rows = [hashes[k : len(hashes) - n + 1 + k] * _SEEDS[200 + k] for k in range(n)]
    return _mix(np.sum(rows, axis=0, dtype=np.uint64) + np.uint64(n))


def labelled(shingles: np.ndarray) -> np.ndarray:
    """The shingles' hashes, made different by the number of the occurrence in the text."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(fresh)
    nth = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    out = np.empty_like(shingles)
    out[order] = _mix(ranked + nth.astype(np.uint64) * _SEEDS[220])
    return out


def sketches(shingles: np.ndarray, count: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """One bucket key for each hash function."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    own = labelled(shingles)
    taken = min(taken, len(own))
    ranks = (own[None, :] ^ _SEEDS[:count, None]) * (_SEEDS[30 : 30 + count, None] | np.uint64(1))
    least, every = np.empty((count, taken), np.int64), np.arange(count)
    for k in range(taken):
        least[:, k] = ranks.argmin(axis=1)
        ranks[every, least[:, k]] = np.uint64((1 << 64) - 1)
    least.sort(axis=1)  # in text order
    keys = _SEEDS[100 : 100 + count].copy()
    for k in range(taken):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + own[least[:, k]])
    return keys


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """The alignment's S / (a + b - S), or 0.0 where it can't reach the threshold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    total = len(a) + len(b)
    over, under = ratio(threshold)
    least = -(-over * total // (over + under))  # matches that are needed, in whole numbers
    if min(len(a), len(b)) < least:
        return 0.0
    head = _same_ahead(a, b)
    tail = _same_ahead(a[head:][::-1], b[head:][::-1])
    rest_a, rest_b = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    matched = head + tail
    common = Counter(rest_a) & Counter(rest_b)
    if matched + sum(common.values()) < least:
        return 0.0
    if common:
        matched += _aligned(rest_a, rest_b, total - 2 * least + 1)
    return matched / (total - matched) if matched >= least else 0.0


def ratio(threshold: float) -> tuple[int, int]:
    """The threshold as it is written, in whole numbers: 0.8 is 4 / 5."""
    return Fraction(str(float(threshold))).as_integer_ratio()


def _same_ahead(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    return int(unlike[0]) if len(unlike) else n


def _aligned(a: list, b: list, band: int) -> int:
    """The longest common subsequence within this many diagonals, with a bit per element of b."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    every = (1 << len(b)) - 1
    width = (1 << (2 * band + 1)) - 1
    row = every
    for i, x in enumerate(a):
        here = places.get(x)
        if here:
            here &= width << (i - band) if i >= band else width >> (band - i)
            met = row & here
            row = ((row + met) | (row - met)) & every
    return len(b) - row.bit_count()


def sketched(docs: DataFrame, text_col: str) -> DataFrame:
    """(t, n, keys): of each different text its key, number of shingles and sketches; texts
    without words have none and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                rows = []
                for text in set(texts_of(part, text_col)):
                    shingles = shingle_hashes(words_of(text))
                    if len(shingles):
                        keys = sketches(shingles).view(np.int64).tolist()
                        rows.append((hashlib.md5(text.encode()).digest(), len(shingles), keys))
                if rows:
                    kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["t", "n", "keys"])
        _WORDS.clear()  # the worker goes on to other tasks

    return docs.select(text_col).mapInArrow(run, "t BINARY, n BIGINT, keys ARRAY<BIGINT>").dropDuplicates(["t"])


def shingled(texts: DataFrame) -> DataFrame:
    """(t, shingles): the labelled shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = [labelled(shingle_hashes(words_of(text))).view(np.int64) for text in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], ["t", "shingles"])
        _WORDS.clear()

    return texts.select("t", "text").mapInArrow(run, "t BINARY, shingles ARRAY<BIGINT>")


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How many shingles of all the texts (t, shingles) fall into each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            counts += np.bincount(_slots(batch.column(1).flatten().to_numpy()), minlength=1 << SLOT_BITS)
        slots = np.flatnonzero(counts)
        for k in range(0, len(slots), 100_000):
            own = slots[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], ["slot", "n"])

    found = texts.select("t", "shingles").mapInArrow(run, "slot BIGINT, n BIGINT").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def prefixes(texts: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """(bucket, t, n, ahead): the shingles, rare slots first, one of which any text at the threshold
    shares; ahead is how many of the text's n shingles come from there on, in this order."""
    sent = texts.sparkSession.sparkContext.broadcast(counts)
    over, under = ratio(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.column(1)[k].values.to_numpy()
                n = len(own)
                some = n + over * n // -under + 1  # n - ceil(threshold * n) + 1
                first = own[np.lexsort((own, sent.value[_slots(own)]))[:some]]
                t, whole = pa.repeat(batch.column(0)[k], len(first)), pa.repeat(pa.scalar(n, pa.int64()), len(first))
                ahead = pa.array(n - np.arange(len(first), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(first), t, whole, ahead], ["bucket", "t", "n", "ahead"])

    return texts.select("t", "shingles").mapInArrow(run, "bucket BIGINT, t BINARY, n BIGINT, ahead BIGINT")


def aligned_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (t, u, text, other) that align, as (t, u)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shingles = None, None
        for batch in batches:
            for part in slices(batch, "text"):
                good = []
                for name, text, other in zip(*[part.column(k) for k in (1, 2, 3)]):
                    if name != last:  # pairs come by leader
                        last, shingles = name, shingle_hashes(words_of(other.as_py()))
                    good.append(similarity(shingle_hashes(words_of(text.as_py())), shingles, threshold) >= threshold)
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))
        _WORDS.clear()

    return pairs.select("t", "u", "text", "other").mapInArrow(run, "t BINARY, u BINARY")


class Texts:
    """Fetches the texts of some keys."""

    def __init__(self, docs: DataFrame, text_col: str, staging: Staging, broadcast_keys: int):
        self.docs = docs.select(text_key(F.col(text_col)).alias("t"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        self.staging, self.broadcast_keys = staging, broadcast_keys

    def of(self, pairs: DataFrame, name: str) -> DataFrame:
        return self.at(pairs.select(F.explode(F.array("t", "u")).alias("t")), name)

    def at(self, keys: DataFrame, name: str) -> DataFrame:
        keys = keys.distinct()
        keys, seen = self.staging.write(keys, f"{name}-keys", {"n": F.count(F.lit(1))})
        if seen["n"] <= self.broadcast_keys:
            keys = F.broadcast(keys)
        found = self.staging.write(self.docs.join(keys, "t", "left_semi").dropDuplicates(["t"]), f"{name}-texts")[0]
        self.staging.discard(f"{name}-keys")
        return found

    def forget(self, name: str) -> None:
        self.staging.discard(f"{name}-texts")


class Linking:
    """Pairs that have been tried, links found and the classes they make so far."""

    def __init__(self, docs: DataFrame, text_col: str, threshold: float, staging: Staging, broadcast_keys: int):
        self.texts = Texts(docs, text_col, staging, broadcast_keys)
        self.threshold, self.staging = threshold, staging
        self.tried = self.roots = self.named = None
        self.turn = 0

    def rooted(self, members: DataFrame) -> DataFrame:
        """members with the root of each one's class."""
        if self.roots is None:
            return members.withColumn("root", F.col("t"))
        return members.join(self.roots, "t", "left").withColumn("root", F.coalesce("root", "t"))

    def mixed(self, members: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The members, with their roots, of the buckets that hold several classes."""
        members, _ = self.staging.write(self.rooted(members), f"{name}-rooted")
        several = members.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
        members, seen = self.staging.write(members.join(several.select("bucket"), "bucket"), name, {"n": F.count(F.lit(1))})
        self.staging.discard(f"{name}-rooted")
        return members, seen["n"]

    def compare(self, led: DataFrame) -> None:
        """Align the texts t and u (of n and m shingles) of each row that have not been yet."""
        over, under = ratio(self.threshold)
        close = F.least("n", "m") * under >= F.greatest("n", "m") * over
        pairs = led.where(close).select(F.least("t", "u").alias("t"), F.greatest("t", "u").alias("u")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["t", "u"], "left_anti")
        pairs, seen = self.staging.write(pairs, f"pairs-{self.turn}", {"n": F.count(F.lit(1))})
        if seen["n"]:
            own = self.texts.of(pairs, f"turn-{self.turn}")
            named = own.select(F.col("t").alias("u"), F.col("text").alias("other"))
            both = pairs.join(own, "t").join(named, "u")
            good, linked = self.staging.write(aligned_pairs(both, self.threshold), f"links-{self.turn}", {"n": F.count(F.lit(1))})
            self.texts.forget(f"turn-{self.turn}")
            self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
            if linked["n"]:
                self.contract(good)
            self.staging.discard(f"links-{self.turn}")
        self.turn += 1

    def contract(self, links: DataFrame) -> None:
        """Make one class of what new links (t, u) join: only they and the roots they touch are looked at."""
        edges = self.apart(links).select(F.col("root").alias("t"), F.col("other").alias("u")).distinct()
        edges, seen = self.staging.write(edges, f"edges-{self.turn}", {"n": F.count(F.lit(1))})
        if seen["n"]:
            moved = components(edges, self.staging, f"classes-{self.turn}")
            if self.roots is not None:
                onward = moved.select(F.col("t").alias("root"), F.col("root").alias("new"))
                old = self.roots.join(onward, "root", "left").select("t", F.coalesce("new", "root").alias("root"))
                moved = moved.unionByName(old)
            before, name = self.named, f"roots-{self.turn}"
            self.roots, self.named = self.staging.write(moved, name)[0], name
            self.staging.discard(*[n for n in (before,) if n], f"classes-{self.turn}")
        self.staging.discard(f"edges-{self.turn}")

    def compare_unlike(self, keys: DataFrame) -> None:
        """Align each two texts of these keys (t) that have different classes and may align."""
        own, _ = self.staging.write(shingled(self.texts.at(keys, "unlike")), "shingles")
        self.texts.forget("unlike")
        members, seen = self.mixed(prefixes(own, slot_counts(own), self.threshold), "prefixes")
        self.staging.discard("shingles")
        if not seen:
            return
        # All but the largest class of a bucket look for partners in it.
        sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
        largest = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("largest"))
        seeking = members.join(largest, "bucket").where("root <> largest").drop("largest")
        met = members.toDF("bucket", *[f"other_{c}" for c in members.columns[1:]])
        over, under = ratio(self.threshold)
        most = F.least("ahead", "other_ahead")  # shingles in common, where this is the first
        may = (F.col("root") != F.col("other_root")) & (most * (over + under) >= (F.col("n") + F.col("other_n")) * over)
        a, b = F.struct("t", "n"), F.struct(F.col("other_t").alias("t"), F.col("other_n").alias("n"))
        # Texts that may align are in the same band of lengths or in neighbouring ones.
        band = F.floor(F.log("n") / (1.01 * math.log(under / over)))
        seeking = seeking.withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
        met = met.withColumn("band", F.floor(F.log("other_n") / (1.01 * math.log(under / over))))
        pairs = seeking.join(met, ["bucket", "band"]).where(may).groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        pairs = pairs.agg(F.count(F.lit(1)).alias("shared")).select("a.t", "a.n", F.col("b.t").alias("u"), F.col("b.n").alias("m"), "shared")
        pairs, seen = self.staging.write(pairs, "unlike-pairs", {"n": F.count(F.lit(1))})
        self.staging.discard("prefixes")
        if seen["n"]:
            # Of two classes first the pair with most in common: if it aligns, they are one class.
            classes = F.array_sort(F.array("root", "other")).alias("classes")
            best = F.max_by(F.struct("t", "n", "u", "m"), F.struct("shared", "t", "u")).alias("best")
            self.compare(self.apart(pairs).groupBy(classes).agg(best).select("best.*"))
            self.compare(self.apart(pairs))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose texts t and u have different classes, with both (root, other)."""
        others = self.rooted(pairs.select(F.col("u").alias("t")).distinct()).select(F.col("t").alias("u"), F.col("root").alias("other"))
        return self.rooted(pairs).join(others, "u").where("root <> other")


def leaders_of(members: DataFrame) -> DataFrame:
    """The heaviest member of each bucket."""
    first = members.groupBy("bucket").agg(F.min(F.struct(-F.col("weight"), "t", "n", "root")).alias("first"))
    return first.select("bucket", F.col("first.t").alias("u"), F.col("first.n").alias("m"), F.col("first.root").alias("leading"))


def together_in(every: DataFrame, members: DataFrame, groups: list[tuple[int, ...]]) -> DataFrame:
    """The members' texts in buckets of several sketches each."""
    keys = F.array(*[F.xxhash64(F.lit(k), *[F.col("keys")[i] for i in g]) for k, g in enumerate(groups)])
    texts = members.select("t", "weight").distinct()
    return every.join(texts, "t").select(F.explode(keys).alias("bucket"), "t", "n", "weight")


def linked(
    docs: DataFrame,
    text_col: str,
    threshold: float,
    staging: Staging,
    broadcast_keys: int = BROADCAST_KEYS,
    single_rounds: int = SINGLE_ROUNDS,
) -> DataFrame | None:
    """(t, root): the class of each text that aligns with another and isn't its class's root."""
    every, _ = staging.write(sketched(docs, text_col), "sketches")
    coarse = every.select(F.explode("keys").alias("bucket"), "t", "n")
    sizes = coarse.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    coarse, _ = staging.write(coarse.join(sizes, "bucket"), "coarse-members")
    weights, _ = staging.write(coarse.groupBy("t").agg(F.sum("size").alias("weight")), "weights")
    coarse = coarse.select("bucket", "t", "n").join(weights, "t")
    linking = Linking(docs, text_col, threshold, staging, broadcast_keys)
    coarse, _ = staging.write(linking.rooted(coarse), "coarse")
    staging.discard("coarse-members", "weights")
    linking.compare(coarse.join(leaders_of(coarse), "bucket").where("t <> u"))
    left, seen = linking.mixed(coarse.drop("root"), "coarse-mixed")
    staging.discard("coarse")
    if not seen:
        return linking.roots
    fine, seen = linking.mixed(together_in(every, left, PAIRED), "fine")
    staging.discard("sketches")
    waiting = fine.select("bucket", "t", "n", "weight")
    for turn in range(single_rounds):
        if not seen:
            break
        # A class is done with in a bucket once a member of it has led there.
        now, seen = linking.mixed(waiting, f"waiting-{turn}")
        first, _ = staging.write(leaders_of(now), f"leaders-{turn}")
        linking.compare(linking.rooted(fine.drop("root")).join(first, "bucket").where("root <> leading"))
        done = linking.rooted(first.select("bucket", F.col("u").alias("t"))).select("bucket", "root")
        rest = linking.rooted(now.drop("root")).join(done, ["bucket", "root"], "left_anti")
        waiting, _ = staging.write(rest.select("bucket", "t", "n", "weight"), f"rest-{turn}")
        staging.discard(f"waiting-{turn}", f"leaders-{turn}", f"rest-{turn - 1}")
    staging.discard("fine")
    # What was done with above has not met the members that have not led: it meets them here.
    left, seen = linking.mixed(left.drop("root"), "coarse-last")
    if seen:
        linking.compare_unlike(left.select("t"))
    return linking.roots


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(t, root): every text that has a link and isn't the root, the smallest key, itself."""

    def stars(edges: DataFrame, name: str) -> tuple[DataFrame, dict]:
        """Point everything around a node to the smallest around it: first what is larger than
        the node, then what is smaller and the node itself."""
        both = edges.unionByName(edges.select(F.col("u").alias("t"), F.col("t").alias("u")))
        least = both.groupBy("t").agg(F.min("u").alias("m")).select(F.col("t").alias("v"), F.least("t", "m").alias("m"))
        large = both.where("u > t").join(least, F.col("t") == F.col("v")).select(F.col("u").alias("t"), F.col("m").alias("u"))
        large = large.where("t <> u").distinct()
        least = large.groupBy("t").agg(F.min("u").alias("m")).select(F.col("t").alias("v"), "m")
        joined = large.join(least, F.col("t") == F.col("v"))
        small = joined.select(F.col("u").alias("t"), F.col("m").alias("u")).unionByName(joined.select("t", F.col("m").alias("u")))
        small = small.where("t <> u").distinct()
        return staging.write(small, name, {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64("t", "u").cast("decimal(38,0)"))})

    last, turn = None, 0
    while True:
        edges, seen = stars(edges, f"{name}/{turn}")
        if turn:
            staging.discard(f"{name}/{turn - 1}")
        if seen == last or not seen["n"]:
            break
        last, turn = seen, turn + 1
    return edges.select("t", F.col("u").alias("root"))


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    staging: Staging | None = None,
    **options,
) -> DataFrame:
    """One row per row of docs: the id, its text's key t, its class by the smallest key (root) and
    by the smallest id (class_id), and class_size, the rows of the class."""
    staging = staging or Staging(docs.sparkSession)
    docs = columns(docs, id_col, text_col)
    roots = linked(docs, text_col, threshold, staging, **options)
    keyed, _ = staging.write(docs.select(id_col, text_key(F.col(text_col)).alias("t")), "keys")
    rooted = keyed.withColumn("root", F.col("t"))
    if roots is not None:
        rooted = keyed.join(roots, "t", "left").withColumn("root", F.coalesce("root", "t"))
    named = rooted.groupBy("root").agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rooted.join(named, "root").select(id_col, "t", "root", "class_id", "class_size")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, staging: Staging | None = None
) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their class: one row of
    each, also where rows are equal or two texts of a class have one id (the smaller key stays)."""
    staging = staging or Staging(docs.sparkSession)
    found, _ = staging.write(classes(docs, id_col, text_col, threshold, staging), "classes")
    first = found.where(F.col(id_col).eqNullSafe(F.col("class_id")))
    keep = first.groupBy("root").agg(F.min(F.struct("t", "class_id")).alias("first")).select("first.*")
    keep = keep.select(F.xxhash64("class_id", "t").alias("its_row"), F.col("t").alias("its_t"), "class_id")
    rows = docs.select(F.struct("*").alias("all"), text_key(F.col(text_col)).alias("t"), F.col(id_col).alias("own_id"))
    rows = rows.withColumn("row", F.xxhash64("own_id", "t"))
    same = (F.col("row") == F.col("its_row")) & F.col("own_id").eqNullSafe(F.col("class_id")) & (F.col("t") == F.col("its_t"))
    kept = rows.join(keep, same, "left_semi").dropDuplicates(["row", "own_id", "t"])
    return kept.select(*[F.col("all")[c].alias(c) for c in docs.columns])
