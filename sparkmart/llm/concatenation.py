"""Concatenate and cut: the tokens of all documents as one stream, cut into windows of one length.

Pass one tokenizes each document where it is read, puts its end token behind it, and writes its
ids with the number of tokens before it in its task. The tasks' totals, one row per task, are
summed up to the place in the stream where each task begins. Pass two reads the ids again, knows
every document's global place, and cuts it at the edges of the windows. No text and no id is
shuffled. What is left behind the last full window is cut at the powers of two that make it up,
so that, where a length that is a power of two needs no padding, there is none at all.

A window that lies in one task whole is put together there (sequences). Of the others, each task
gives its part as a boundary record; these are few, and are joined by window.

A null or empty text is the end token alone. Very long texts need no rule of their own: a document
is cut wherever an edge falls, into any number of pieces. Repeated rows are packed repeatedly; the
order of the stream is that in which tasks read the rows, so nothing depends on ties or null ids.
An empty table gives an empty one. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import columns
from sparkmart.llm.packing import encoded
from sparkmart.staging import Staging

#: Token ids below this fit two bytes.
SHORT = 1 << 16


@lru_cache
def tail_edges(total: int, length: int) -> tuple[int, ...]:
    """Where the windows behind the last full one begin, and where the stream ends."""
    edges = [total - total % length]
    for bit in range((total % length).bit_length() - 1, -1, -1):
        if total % length >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    return tuple(edges)


def cuts(start: int, end: int, length: int, tail: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """(sequence, offset, from, to) of the pieces of a document at [start, end) of the stream."""
    pieces, at = [], start
    while at < end:
        if at < tail[0]:
            number, begin = divmod(at, length)[0], at - at % length
            stop = begin + length
        else:
            nth = next(k for k in range(len(tail) - 1) if at < tail[k + 1])
            number, begin, stop = tail[0] // length + nth, tail[nth], tail[nth + 1]
        pieces.append((number, at - begin, at, min(stop, end)))
        at = pieces[-1][3]
    return pieces


def stream(
    docs: DataFrame,
    model: Broadcast,
    staging: Staging | None = None,
    end: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, doc_tokens, ids, place, total): every document's ids, two or four bytes each, and its
    global place in the stream of total tokens; staged."""
    from tokenizers import Tokenizer

    staging = staging or Staging(docs.sparkSession)
    docs = columns(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    most = max(end, *Tokenizer.from_str(model.value).get_vocab().values())
    width = "<u2" if most < SHORT else "<u4"
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        for part, texts in encoded(batches, model, text_col):
            ids = [np.frombuffer(t + last, "<u4").astype(width).tobytes() for t in texts]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // 4 + 1
            stops = before + np.cumsum(sizes)
            arrays = [part.column(id_col), pa.array(sizes), pa.array(ids, pa.binary())]
            arrays += [pa.array(np.full(len(texts), task, np.int64)), pa.array(stops - sizes)]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "doc_tokens", "ids", "_task", "_before"])
            before = int(stops[-1]) if len(stops) else before

    schema = f"`{id_col}` {kind}, doc_tokens BIGINT, ids BINARY, _task BIGINT, _before BIGINT"
    staged, _ = staging.write(docs.mapInArrow(run, schema), "ids")
    # One row per task of the write, whatever the size of the data.
    totals = staged.groupBy("_task").agg(F.max(F.col("_before") + F.col("doc_tokens")).alias("_tokens"))
    upto = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "_task",
        (F.sum("_tokens").over(upto) - F.col("_tokens")).alias("_start"),
        F.sum("_tokens").over(whole).alias("total"),
    )
    placed = staged.join(F.broadcast(starts), "_task")
    return placed.select(id_col, "doc_tokens", "ids", (F.col("_start") + F.col("_before")).alias("place"), "total")


def _ids(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")


def _documents(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def cut(placed: DataFrame, length: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """The pieces of the documents of a stream: (id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)."""
    kind = placed.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, owner = [], []
            for k, (n, raw, place, total) in enumerate(_documents(batch, ("doc_tokens", "ids", "place", "total"))):
                ids, tail = _ids(raw, n).tobytes(), tail_edges(total, length)
                for number, offset, a, b in cuts(place, place + n, length, tail):
                    check = zlib.crc32(ids[4 * (a - place) : 4 * (b - place)])
                    owner.append(k)
                    rows.append((a - place, b - a, check, n, number, offset))
            values = list(zip(*rows)) if rows else [()] * 6
            arrays = [batch.column(id_col).take(pa.array(owner, pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(x, pa.int64()) for x in values], names)

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} BIGINT" for n in names[1:])
    return placed.mapInArrow(run, schema)


def boundaries(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One record for each edge that falls inside a document: the window that begins there, the
    document, how many of its tokens lie before the edge and how many behind."""
    left = (F.col("doc_tokens") - F.col("start")).alias("tokens_behind")
    return pieces.where("start > 0").select("sequence_id", id_col, F.col("start").alias("tokens_before"), left)


def sequences(placed: DataFrame, length: int = 2048) -> DataFrame:
    """(sequence_id, n_tokens, n_padding, ids): the windows with their ids, four bytes each.

    n_padding is what fills up a window to length, unless its size is a power of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        window, begin, held, at, size = -1, 0, [], -1, 0

        def closed() -> None:
            if held:
                found.append((window, begin, size, np.concatenate(held).tobytes()))

        for batch in batches:
            for n, raw, place, total in _documents(batch, ("doc_tokens", "ids", "place", "total")):
                ids, tail = _ids(raw, n), tail_edges(total, length)
                for number, offset, a, b in cuts(place, place + n, length, tail):
                    if number != window or a != at:
                        closed()
                        window, begin, held = number, offset, []
                        nth = number - tail[0] // length
                        size = length if nth < 0 else tail[nth + 1] - tail[nth]
                    held.append(ids[a - place : b - place])
                    at = b
                if len(found) >= 500:
                    yield _windows(found)
                    found = []
        closed()
        yield _windows(found)

    schema = "sequence_id BIGINT, offset BIGINT, n_tokens BIGINT, ids BINARY"
    parts = placed.mapInArrow(run, schema)
    here = F.octet_length("ids") == 4 * F.col("n_tokens")
    records = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # no more than a window has tokens
    joined = F.unhex(F.array_join(F.transform(records, lambda r: F.hex(r["ids"])), ""))
    met = parts.where(~here).groupBy("sequence_id", "n_tokens").agg(joined.alias("ids"))
    both = parts.where(here).select("sequence_id", "n_tokens", "ids").unionByName(met)
    power = F.bit_count("n_tokens") == 1
    padding = F.when(power, F.lit(0)).otherwise(F.lit(length) - F.col("n_tokens")).cast("long")
    return both.select("sequence_id", "n_tokens", padding.alias("n_padding"), "ids")


def _windows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    values = list(zip(*found)) if found else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, kinds)], ["sequence_id", "offset", "n_tokens", "ids"])
