"""Decontamination against a benchmark of any size, by shuffle.

Where the test items are too many to go to every task (decontaminate.py), their windows become a
table. Two things are known of each: a 64-bit hash, whose first bits set a bit in a bitmap of fixed
size, which goes to every task, and a digest of 128 bits, by which windows are equal. A task looks up
each window of its documents in the bitmap; only those that it lets through, as good as all of them
windows of the benchmark, get a digest and are joined with the items' windows. Windows that follow
each other in an item and in a document are one verbatim match; the longest ones come of that. The
bitmap's size decides how much is joined, and nothing else.

Results are those of Decontaminator, in all the cases that it states.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, per_slice, texts_of
from sparkmart.llm.decontaminate import _APART, BLOCK_CHARS, Decontaminator
from sparkmart.llm.spans import STEP, hashes, mixed, spans
from sparkmart.staging import Staging

#: Characters of a benchmark up to which its items go to every task.
BROADCAST_CHARS = 8 * BLOCK_CHARS
#: Bits that name a part of the bitmap; a part is put together by one task.
PART_BITS = 8


def window_hashes(text: str, lengths: list[int]) -> tuple[list[bytes], dict[int, np.ndarray]]:
    """The words of a text, and the hashes of all its windows of each length."""
    folded = text.encode().lower().translate(_APART)
    words = folded.split()
    buffer = np.frombuffer(folded, np.uint8)
    starts, ends = spans(~np.isin(buffer, (32, *range(9, 14))))
    own = hashes(buffer, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    found = {}
    for n in lengths:
        count = max(len(own) - n + 1, 0)
        key = np.full(count, n, np.uint64)
        for j in range(n):
            key = mixed(key * STEP + own[j : j + count])
        found[n] = key
    return words, found


def digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


class ShuffledDecontaminator:
    """The windows of a benchmark as a table; they measure and filter documents."""

    def __init__(
        self,
        benchmark: DataFrame,
        item_id: str = "item_id",
        item_text: str = "text",
        window: int = 13,
        ratio: int = 20,
        filter_bits: int = 28,
        staging: Staging | None = None,
    ):
        """A document is contaminated if it is hit and hits times ratio reach its words."""
        self.window, self.ratio, self.filter_bits = window, ratio, filter_bits
        self.staging = staging or Staging(benchmark.sparkSession)
        items = columns(benchmark, item_id, item_text).toDF("item_id", "text").dropDuplicates()
        self.id_type = items.schema["item_id"].dataType.simpleString()
        windows = per_slice(
            items, "text", f"item_id {self.id_type}, item BINARY, n INT, k BIGINT, place BIGINT, window BINARY", self._listed()
        )
        self.windows, _ = self.staging.write(windows, "windows")
        # window different lengths at most
        self.lengths = sorted(r.n for r in self.windows.select("n").distinct().collect())
        self.bitmap = benchmark.sparkSession.sparkContext.broadcast(self._bits())

    def _listed(self):
        window, bits = self.window, self.filter_bits

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, owner = [], []
            for i, (own, text) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch, "text"))):
                item = hashlib.md5(f"{own}\n{text}".encode()).digest()
                size = len(window_hashes(text, [])[0])
                n = min(window, size)
                if n:
                    words, keys = window_hashes(text, [n])
                    for k, place in enumerate((keys[n] >> np.uint64(64 - bits)).tolist()):
                        owner.append(i)
                        rows.append((item, n, k, place, digest(words[k : k + n])))
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            values = list(zip(*rows)) if rows else [()] * 5
            arrays = [batch.column(0).take(pa.array(owner, pa.int64()))] + [pa.array(x, t) for x, t in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["item_id", "item", "n", "k", "place", "window"])

        return work

    def _bits(self) -> bytes:
        """The bitmap: a fixed number of bits, whatever the number of windows."""
        size = 1 << (self.filter_bits - PART_BITS)

        def part(key: tuple, table: pa.Table) -> pa.Table:
            bits = np.zeros(size, bool)
            bits[table.column("place").to_numpy() & (size - 1)] = True
            return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        places = self.windows.select("place").distinct().withColumn("part", F.shiftright("place", self.filter_bits - PART_BITS))
        whole = np.zeros(1 << (self.filter_bits - 3), np.uint8)
        for row in places.groupBy("part").applyInArrow(part, "part BIGINT, bits BINARY").collect():  # the bitmap
            whole[row.part * (size >> 3) : (row.part + 1) * (size >> 3)] = np.frombuffer(row.bits, np.uint8)
        return whole.tobytes()

    def _found(self, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
        """(row, id, n_words) of each document, and (row, item_id, item, n, k, at) of all windows met."""
        bitmap, lengths, shift = self.bitmap, self.lengths, np.uint64(64 - self.filter_bits)
        docs = columns(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
        kind = docs.schema[id_col].dataType.simpleString()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bits = np.frombuffer(bitmap.value, np.uint8)
            sizes, hits = [], []
            for text in texts_of(batch, text_col):
                words, keys = window_hashes(text, lengths)
                sizes.append(len(words))
                own = []
                for n, key in keys.items():
                    place = key >> shift
                    let = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0
                    own += [{"n": n, "at": k, "window": digest(words[k : k + n])} for k in np.flatnonzero(let).tolist()]
                hits.append(own)
            arrow = pa.list_(pa.struct([("n", pa.int32()), ("at", pa.int64()), ("window", pa.binary())]))
            arrays = [batch.column("_row"), batch.column(id_col), pa.array(sizes, pa.int64()), pa.array(hits, arrow)]
            return pa.RecordBatch.from_arrays(arrays, ["_row", id_col, "n_words", "hits"])

        schema = f"_row BIGINT, `{id_col}` {kind}, n_words BIGINT, hits ARRAY<STRUCT<n: INT, at: BIGINT, window: BINARY>>"
        seen, _ = self.staging.write(per_slice(docs, text_col, schema, work), f"seen-{uuid.uuid4().hex}")
        hits = seen.select("_row", F.explode("hits").alias("hit")).select("_row", "hit.*")
        met = hits.join(self.windows.drop("place"), ["n", "window"]).select("_row", "item_id", "item", "n", "k", "at")
        return seen.select("_row", id_col, "n_words"), met

    @staticmethod
    def _runs(met: DataFrame) -> DataFrame:
        """Windows that follow each other in item and document as one match."""
        diagonal = Window.partitionBy("_row", "item", F.col("at") - F.col("k")).orderBy("at")
        run = (F.col("at") - F.row_number().over(diagonal)).alias("run")
        return (
            met.select("_row", "item_id", "item", "n", "k", "at", run)
            .groupBy("_row", "item_id", "item", "n", (F.col("at") - F.col("k")).alias("diagonal"), "run")
            .agg(F.min("k").alias("item_start"), F.min("at").alias("doc_start"), (F.count(F.lit(1)) + F.col("n") - 1).alias("length"))
        )

    def measure(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """As Decontaminator.measure."""
        seen, met = self._found(docs, id_col, text_col)
        # Words in the union of the windows: what each adds behind the ends of those before it.
        before = Window.partitionBy("_row").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
        places = met.select("_row", "at", "n").distinct()
        reached = F.coalesce(F.max(F.col("at") + F.col("n")).over(before), F.lit(0))
        added = F.greatest(F.col("at") + F.col("n") - F.greatest("at", reached), F.lit(0))
        hit = places.select("_row", added.alias("added")).groupBy("_row").agg(F.sum("added").alias("n_hit"))
        names = F.array_sort(F.collect_list(F.col("item_id").cast("string")))
        items = met.select("_row", "item_id").distinct().groupBy("_row").agg(
            F.count(F.lit(1)).alias("n_items"), F.array_join(names, ",").alias("names")
        )
        longest = self._runs(met).groupBy("_row").agg(F.max("length").alias("longest_match"))
        whole = seen.join(hit, "_row", "left").join(items, "_row", "left").join(longest, "_row", "left")
        whole = whole.fillna(0, ["n_hit", "n_items", "longest_match"]).fillna("", ["names"])
        return whole.select(
            id_col, "n_words", "n_hit", "n_items", F.sha2(F.col("names").cast("binary"), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (self.ratio * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            F.col("longest_match").cast("long").alias("longest_match"),
        )

    def matches(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """As Decontaminator.matches."""
        seen, met = self._found(docs, id_col, text_col)
        return seen.join(self._runs(met), "_row").select(id_col, "item_id", "item_start", "doc_start", F.col("length").cast("long").alias("length"))

    def clean(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of docs, with all their columns, that are not contaminated."""
        numbered, _ = self.staging.write(docs.select(F.struct("*").alias("all"), F.monotonically_increasing_id().alias("_at")), f"docs-{uuid.uuid4().hex}")
        judged = self.measure(numbered.select("_at", F.col("all")[text_col].alias("text")), "_at", "text")
        kept = numbered.join(judged.where("contaminated").select("_at"), "_at", "left_anti")
        return kept.select(*[F.col("all")[c].alias(c) for c in docs.columns])


def decontaminator(
    benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", broadcast_chars: int = BROADCAST_CHARS, **options
) -> Decontaminator | ShuffledDecontaminator:
    """The one that fits the size of the benchmark, which is counted."""
    size = benchmark.agg(F.sum(F.length(item_text))).first()[0] or 0
    kind = Decontaminator if size <= broadcast_chars else ShuffledDecontaminator
    return kind(benchmark, item_id, item_text, **options)
