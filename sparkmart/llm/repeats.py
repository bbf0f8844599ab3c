"""Repeated passages by a sparse suffix array and its common-prefix interval tree.

Every window of `WINDOW` bytes has an anchor: its smallest GRAM-byte string by hash, the leftmost
of equals. Equal windows have equal anchors at equal places, so only suffixes at anchors are
sorted, and only anchors that occur in several texts go on. Around those, the bytes of all windows
they anchor are gathered by anchor: what follows the anchor forms a sorted suffix array, and one
stack scan over its common prefixes gives the interval tree. The occurrences of an interval are
extended to the left in a tree of their own; where the byte to the left differs, the interval is a
maximal repeat, with all its occurrences and not just neighbours. A byte goes if a window over it
is also in a document with a smaller id.

Equal texts count as one text, that of the smallest id; a later copy goes as a whole. Anchors
are gathered by hash in buckets of bounded size; a string that many texts of a task share is sent
once. Contexts are counted by anchor before they are dealt: a task holds those of one anchor, up to
HOT_CONTEXTS of them. The windows of an anchor with more are settled one by one, in streams sorted by
window and id, at up to 32 rows for each context. Windows are decided by the bytes, or 128 bits of
their digest, and texts found again by their id and digest; shorter hashes only bring candidates
together.

Null texts are empty; texts shorter than a window lose nothing, whether copies or not. A null id
counts as larger than all others. Rows with one id don't take from each other; equal rows give
equal results. A very long text is one row like others. An empty table gives an empty one. Other
columns, whatever their names, go no further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices, texts_of
from sparkmart.staging import Staging

WINDOW, GRAM = 50, 19
_SPAN = WINDOW - GRAM + 1  # 32 anchors to choose from, a power of two
_LOW = np.uint64((1 << 32) - 1)
_SIX = np.uint64((1 << 48) - 1)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
LAST_ID = (1 << 63) - 1

#: Bytes of text whose anchors make up a bucket, more or less.
BUCKET_BYTES = 16 << 20
#: Row keys (16 bytes) up to this number are broadcast to select texts.
BROADCAST_KEYS = 1_000_000
#: Different contexts of an anchor that a task holds at most, some 100 MB.
HOT_CONTEXTS = 200_000


def anchors(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Of all anchors, in text order: the text's number, the place, the first and last window
    start that it anchors, and its hash."""
    found: list[list[np.ndarray]] = []
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= 1 << 18 or k == len(texts) - 1:  # what fits a processor's cache
            found.append(_anchors(texts[first : k + 1], first))
            first, size = k + 1, 0
    names = ("text", "place", "start", "end", "hash")
    if not found:
        return dict(zip(names, [*[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64)]))
    return {n: np.concatenate(x) for n, x in zip(names, zip(*found))}


def _anchors(texts: list[bytes], number: int) -> list[np.ndarray]:
    raw = b"".join(texts) + bytes(8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    n = len(raw) - 8
    counts = np.maximum(sizes - WINDOW + 1, 0)  # windows of each text
    if not counts.sum():
        return [*[np.zeros(0, np.int64)] * 4, np.zeros(0, np.uint64)]
    eight = np.empty(n + 1, np.uint64)  # the eight bytes from each place on
    for j in range(8):
        view = np.frombuffer(raw, "<u8", (len(raw) - j) // 8, j)
        part = eight[j::8]
        part[:] = view[: len(part)]
    grams = n - GRAM + 1
    hashes = eight[:grams] * _FACTORS[0]
    hashes += eight[8 : grams + 8] * _FACTORS[1]
    hashes ^= hashes >> np.uint64(29)
    hashes += eight[GRAM - 8 : grams + GRAM - 8] * _FACTORS[2]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _FACTORS[3]
    hashes ^= hashes >> np.uint64(29)
    least = (hashes & ~_LOW) | np.arange(grams, dtype=np.uint64)
    span = 1
    while span < _SPAN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = (least[starts + begins[owner]] & _LOW).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    tail = np.append(head[1:], len(place)) - 1
    text = owner[head]
    return [text + number, place[head] - begins[text], starts[head], starts[tail], hashes[place[head]]]


def _name(text: bytes) -> int:
    """The first eight bytes of a text's MD5, as Spark's part_name has them."""
    return int.from_bytes(hashlib.md5(text).digest()[:8], "big", signed=True)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def row_key(id_: Column, key: Column) -> Column:
    """What identifies a text of an id: 16 bytes of a digest of both."""
    return F.unhex(F.md5(F.concat(id_.cast("string").cast("binary"), F.lit(b":"), key)))


def part_name(key: Column) -> Column:
    """The first eight bytes of a key, as a signed number."""
    high = F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long")
    low = F.conv(F.hex(F.substring(key, 5, 4)), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def anchor_buckets(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """Anchors packed for the search for shared ones: per slice and bucket the hashes with one of
    their texts each (kind 0), and per text those that several texts of the slice share (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = [t for t in {t.encode() for t in texts_of(part, text_col)} if len(t) >= WINDOW]
                names = np.array([_name(t) for t in texts], np.int64)
                found = anchors(texts)
                order = np.lexsort([found["text"], found["hash"]])
                hashes, text = found["hash"][order], found["text"][order]
                fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
                begins = np.flatnonzero(fresh)
                ends = np.append(begins[1:], len(hashes)) - 1
                shared = (text[begins] != text[ends])[np.cumsum(fresh) - 1] if len(hashes) else fresh
                rows: list[tuple] = []
                own, which = text[shared], hashes[shared] & _SIX
                own, which = _by(own, which)
                for a, b in _runs(own):
                    name = int(names[own[a]])
                    rows.append((name % buckets, 1, np.array([name]).tobytes(), None, which[a:b].astype("<u8").tobytes()))
                each, owner = hashes[begins], text[begins]
                even = (each * _FACTORS[1]) >> np.uint64(40)  # anchors are small hashes, buckets must be even
                bucket = ((even * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)
                order = np.lexsort([owner, bucket])
                each, owner, bucket = each[order], owner[order], bucket[order]
                for a, b in _runs(bucket):
                    firsts = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                    counts = np.diff(np.append(firsts, b - a))
                    six = (each[a:b] & _SIX).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                    rows.append((
                        int(bucket[a]), 0, names[owner[a:b][firsts]].astype("<i8").tobytes(),
                        counts.astype("<u4").tobytes(), six.tobytes(),
                    ))
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["bucket", "kind", "names", "counts", "hashes"]
                    )

    return docs.select(text_col).mapInArrow(
        run, "bucket BIGINT, kind INT, names BINARY, counts BINARY, hashes BINARY"
    )


def _by(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    return key[order], other[order]


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal keys."""
    if len(keys):
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield from zip(begins.tolist(), [*begins[1:].tolist(), len(keys)])


def shared_anchors(packed: DataFrame, buckets: int) -> DataFrame:
    """(name, hash): the anchors (48 bits of the hash) of each text that other texts have too."""
    names = ["name", "hash"]

    def resolved(names_: list, counts: list, hashes: list) -> Iterator[pa.RecordBatch]:
        if len(names_) < 2:
            return
        owner = np.repeat(np.concatenate(names_), np.concatenate(counts))
        six = np.concatenate(hashes).reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        value = eight.view("<u8").reshape(-1)
        order = np.lexsort([owner, value])
        owner, value = owner[order], value[order]
        fresh = np.concatenate([[True], value[1:] != value[:-1]])
        begins = np.flatnonzero(fresh)
        ends = np.append(begins[1:], len(value)) - 1
        shared = (owner[begins] != owner[ends])[np.cumsum(fresh) - 1]
        owner, value = _by(owner[shared], value[shared])
        for k in range(0, len(owner), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(owner[part]), pa.array(value[part].astype(np.int64))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, ([], [], [])
        for batch in batches:
            for own, kind, owners, counts, hashes in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 1:
                    value = np.frombuffer(hashes, "<u8").astype(np.int64)
                    owner = np.full(len(value), np.frombuffer(owners, "<i8")[0])
                    yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(value)], names)
                    continue
                if own != bucket:
                    yield from resolved(*held)
                    bucket, held = own, ([], [], [])
                for into, what, kind_ in zip(held, (owners, counts, hashes), ("<i8", "<u4", np.uint8)):
                    into.append(np.frombuffer(what, kind_))
        yield from resolved(*held)

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(run, "name BIGINT, hash BIGINT")


class _Firsts:
    """Members with the smallest id by key; what turns out to have a larger one is handed on."""

    def __init__(self, later: Callable[[tuple], None], id_at: int):
        self.of: dict[tuple, list[tuple]] = {}
        self.later, self.id_at = later, id_at

    def add(self, key: tuple, now: tuple) -> None:
        members = self.of.setdefault(key, [])
        if not members or members[0][self.id_at] == now[self.id_at]:
            members.append(now)
        elif members[0][self.id_at] < now[self.id_at]:
            self.later(now)
        else:
            for x in members:
                self.later(x)
            self.of[key] = [now]


def contexts(texts: DataFrame) -> DataFrame:
    """From (row, id, text, hashes): around each of these anchors the bytes of all its windows
    (kind 0), and windows that a smaller id of the slice has in an equal context (kind 1)."""
    names = ["kind", "hash", "id", "row", "start", "end", "before", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from work(part)

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
        texts = [t.encode() for t in texts_of(part, "text")]
        found = anchors(texts)
        bounds = np.searchsorted(found["text"], np.arange(len(texts) + 1))
        keep = np.zeros(len(found["hash"]), bool)
        short = (found["hash"] & _SIX).astype(np.int64)
        for k, wanted in enumerate(part.column(3)):
            a, b = bounds[k], bounds[k + 1]
            keep[a:b] = np.isin(short[a:b], wanted.values.to_numpy())
        out: list[tuple] = []
        # What is settled here goes on by its row: all copies of a passage have the same hash.
        found_in = _Firsts(lambda x: out.append((1, int.from_bytes(x[3][:8], "big", signed=True), *x[2:6], None, None)), 2)
        for k, place, start, end, own in zip(*[found[n][keep].tolist() for n in ("text", "place", "start", "end", "hash")]):
            own = own - (1 << 64) if own >= 1 << 63 else own
            text = texts[k][start : end + WINDOW]
            found_in.add((text, place - start), (0, own, ids[k], rows[k], start, end, place - start, text))
        for members in found_in.of.values():
            out += members
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for k in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[k : k + 50_000]), kinds)], names)

    schema = "kind INT, hash BIGINT, id BIGINT, row BINARY, start BIGINT, end BIGINT, before INT, bytes BINARY"
    return texts.select("row", "id", "text", "hashes").mapInArrow(run, schema)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    return n if a == b else n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def intervals(strings: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """The common-prefix interval tree of sorted strings, by a stack scan over the prefixes of
    neighbours: (length, the parent's length, first, last), children before parents."""
    stack = [(-1, 0)]  # length, first
    for k in range(1, len(strings) + 1):
        length = common_prefix(strings[k - 1], strings[k]) if k < len(strings) else -1
        first = k - 1
        while stack[-1][0] > length:
            own, first = stack.pop()
            yield own, max(length, stack[-1][0]), first, k - 1
        if stack[-1][0] < length:
            stack.append((length, first))


def maximal_repeats(entries: list[tuple[bytes, int]]) -> Iterator[tuple[list[int], int, int, int, int]]:
    """The maximal repeats around one anchor, of contexts (bytes, bytes before the anchor).

    Yields the numbers of all occurrences, how far they agree to the left and to the right, and
    the range (first, behind) of bytes to the left with which a window of them is new: neither in a
    longer interval of the suffixes nor in a wider class to the left.
    """
    right = [text[before:] for text, before in entries]
    left = [text[:before][::-1] for text, before in entries]
    order = sorted(range(len(entries)), key=right.__getitem__)
    for ahead, parent, first, last in intervals([right[k] for k in order]):
        low, high = max(WINDOW - ahead, 0), WINDOW - 1 - max(parent, GRAM - 1)
        if low > high or ahead < GRAM:
            continue
        members = sorted(order[first : last + 1], key=left.__getitem__)
        # Left extensions differ between these: each interval is left-maximal.
        for behind, wider, a, b in intervals([left[k] for k in members]):
            if low <= behind and max(low, wider + 1) <= min(high, behind):
                yield members[a : b + 1], behind, ahead, max(low, wider + 1), min(high, behind) + 1


def covered_windows(gathered: DataFrame) -> DataFrame:
    """(row, start, end): first and last starts of windows that a smaller id has too."""
    names, arrow = ["row", "start", "end"], (pa.binary(), pa.int64(), pa.int64())

    def settle(group: list[tuple]) -> Iterator[tuple[int, int, int]]:
        """group: (id, row, start, end, before, bytes)."""
        done: list[tuple[int, int, int]] = []
        firsts = _Firsts(lambda x: done.append(x[1:4]), 0)
        for now in group:
            firsts.add((now[5], now[4]), now)
        yield from done
        if len(firsts.of) == 1:
            return
        same = list(firsts.of.values())
        for members, _, _, low, high in maximal_repeats([(e[0][5], e[0][4]) for e in same]):
            least = min(same[k][0][0] for k in members)
            for k in members:
                if same[k][0][0] > least:
                    for _, row, start, _, before, _ in same[k]:
                        yield row, start + before - high + 1, start + before - low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_, group, out = None, [], []
        for batch in batches:
            for kind, own, id_, row, start, end, before, text in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 1:
                    out.append((row, start, end))
                    continue
                if own != hash_:
                    if len(group) > 1:
                        out += settle(group)
                    hash_, group = own, []
                group.append((id_, row, start, end, before, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), arrow)], names)
                out = []
        out += settle(group) if len(group) > 1 else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), arrow)], names)

    dealt = gathered.repartition("hash").sortWithinPartitions("hash", "kind")
    return dealt.mapInArrow(run, RANGES)


RANGES = "row BINARY, start BIGINT, end BIGINT"


def single_windows(gathered: DataFrame) -> DataFrame:
    """As covered_windows, window by window: tasks stream the windows in order, the smallest id of
    each first, and hold no group of them."""
    names, arrow = ["window", "id", "row", "start"], (pa.binary(), pa.int64(), pa.binary(), pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, row, start, end, text in zip(*[batch.column(n).to_pylist() for n in ("id", "row", "start", "end", "bytes")]):
                for k in range(end - start + 1):
                    out.append((hashlib.md5(text[k : k + WINDOW]).digest(), id_, row, start + k))
            for k in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[k : k + 20_000]), arrow)], names)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, first = None, 0
        for batch in batches:
            held = []
            for own, id_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != window:
                    window, first = own, id_
                held.append(id_ > first)
            some = batch.filter(pa.array(held, pa.bool_()))
            yield pa.RecordBatch.from_arrays([some.column(2), some.column(3), some.column(3)], ["row", "start", "end"])

    windows = gathered.select("id", "row", "start", "end", "bytes").mapInArrow(
        cut, "window BINARY, id BIGINT, row BINARY, start BIGINT"
    )
    return windows.repartition("window").sortWithinPartitions("window", "id").mapInArrow(later, RANGES)


def settled_windows(gathered: DataFrame, staging: Staging, hot_contexts: int) -> DataFrame:
    """(row, start, end) of the windows that a smaller id has too, from staged contexts."""
    counted = gathered.where("kind = 0").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    hot, seen = staging.write(counted.where(F.col("n") > hot_contexts).select("hash"), "hot", {"n": F.count(F.lit(1))})
    if not seen["n"]:
        return covered_windows(gathered)
    here = gathered.where("kind = 0")
    cold = gathered.where("kind = 1").unionByName(here.join(hot, "hash", "left_anti").select(gathered.columns))
    return covered_windows(cold).unionByName(single_windows(here.join(hot, "hash", "left_semi")))


def remaining(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside all windows that start in these ranges; how many went, in how many runs."""
    steps = np.zeros(len(text) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends + WINDOW, -1)
    gone = np.cumsum(steps[:-1]) > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(np.count_nonzero(gone)), spans


def cut_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    staging: Staging | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    broadcast_keys: int = BROADCAST_KEYS,
    with_bytes: bool = False,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans (removed runs), kept_sha256, and
    with with_bytes the kept bytes. The id must be a whole number."""
    staging = staging or Staging(docs.sparkSession)
    docs = columns(docs, id_col, text_col).select(
        F.col(id_col), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    keyed = docs.withColumn("t", text_key(F.col("text"))).withColumn("row", row_key(F.col("id"), F.col("t")))
    size = F.octet_length("text").cast("long")
    slim = keyed.select(id_col, "id", "t", "row", size.alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    slim, seen = staging.write(slim, "rows", {"bytes": F.coalesce(F.sum("n_bytes"), F.lit(0))})
    firsts, _ = staging.write(slim.groupBy("t").agg(F.min("id").alias("first")), "firsts")
    buckets = max(8, -(-seen["bytes"] // bucket_bytes))
    shared = shared_anchors(anchor_buckets(docs, "text", buckets), buckets)
    lists = shared.groupBy("name").agg(F.collect_list("hash").alias("hashes"))
    owners = firsts.select(part_name(F.col("t")).alias("name"), row_key(F.col("first"), F.col("t")).alias("row"))
    lists, found = staging.write(
        lists.join(owners, "name").groupBy("row").agg(F.flatten(F.collect_list("hashes")).alias("hashes")),
        "shared", {"n": F.count(F.lit(1))},
    )

    def having(rows: DataFrame, n: int) -> DataFrame:
        """The texts of these rows; only theirs are shuffled while the rows are few enough."""
        chosen = keyed.select("row", "id", "text")
        if n <= broadcast_keys:
            chosen = chosen.join(F.broadcast(rows.select("row")), "row", "left_semi")
        return chosen

    gathered, _ = staging.write(contexts(having(lists, found["n"]).join(lists, "row")), "contexts")
    staging.discard("shared")
    settled = settled_windows(gathered, staging, hot_contexts)
    ranges = settled.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    ranges, found = staging.write(ranges, "ranges", {"n": F.count(F.lit(1))})
    staging.discard("contexts")
    cut_names = ["row", "n_removed", "n_spans", "cut_sha", "kept"][: 5 if with_bytes else 4]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                done = []
                for row, text, spans in zip(part.column(0).to_pylist(), texts_of(part, "text"), part.column(2)):
                    pairs = spans.values
                    starts, ends = (pairs.field(n).to_numpy() for n in ("start", "end"))
                    kept, gone, runs = remaining(text.encode(), starts, ends)
                    done.append((row, gone, runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in list(zip(zip(*done), kinds))[: len(cut_names)]], cut_names
                )

    schema = "row BINARY, n_removed BIGINT, n_spans BIGINT, cut_sha STRING" + (", kept BINARY" if with_bytes else "")
    pieces = having(ranges, found["n"]).join(ranges, "row").select("row", "text", "ranges")
    changed = pieces.mapInArrow(cut, schema).dropDuplicates(["row"])
    changed = changed.withColumnRenamed("row", "of_row")
    whole = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= WINDOW)  # a later copy
    joined = slim.join(firsts.withColumnRenamed("t", "of_t"), F.col("t") == F.col("of_t"))
    joined = joined.join(changed, F.col("row") == F.col("of_row"), "left")
    out = [
        F.col(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    ]
    if not with_bytes:
        return joined.select(*out)
    texts = keyed.select("row", "text").dropDuplicates(["row"]).withColumnRenamed("row", "text_row")
    joined = joined.join(texts, F.col("row") == F.col("text_row"))
    kept = F.when(whole, F.lit(b"")).otherwise(F.coalesce("kept", F.col("text").cast("binary")))
    return joined.select(*out, kept.alias("kept"))
