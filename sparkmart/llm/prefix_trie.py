"""The trie of all conversations by their turns, for serving or training with shared prefixes.

A turn's id is 20 bytes: 16 of the SHA-256 of its role and text, and the number of its words, both
big-endian. A conversation is the string of its turns' ids; strings go into adaptive radix trees
with path compression, and only the depths at which a turn ends are nodes of the trie.

No task holds the trie. Each puts the strings of its rows into trees of its own, a bounded number
at a time, and gives every node with the sums of what lies below it; nodes of different tasks are
merged by their id, a digest of the whole prefix, so an opening that most conversations share is
one row per task. Strings are cut into blocks of 64 turns, which start from the id of the node
where the block before ended; a conversation of any length is spread over tasks that way.

Sums over subtrees need no levels. A node is owned by its smallest member, and what a conversation
owns is the end of its path. So it adds what it owns, as one figure, to the nodes of its path above,
by a second pass of trees over the same blocks.

Rows without a conversation id belong to no conversation. Null roles and texts are empty, turns
are ordered with nulls first, equal turn numbers by role and text, repeated rows are turns like
others. A very long text is one id. An empty table gives no node. Other columns, whatever their
names, go no further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import columns
from sparkmart.llm.radix import AdaptiveRadixTree
from sparkmart.operators.keys import POSITION, number_rows
from sparkmart.staging import Staging

#: Bytes of a turn's id, of a node's, of a key before its first turn (block number and node).
TURN, NODE, HEAD = 20, 16, 24
ROOT = bytes(NODE)
BLOCK = 64
KEYS_AT_ONCE, BYTES_AT_ONCE = 50_000, 32 << 20
WORD = r"[^\x20\x09-\x0D]+"


def turn_id(role: Column, text: Column) -> Column:
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 8, "0")
    return F.unhex(F.concat(F.substring(digest, 1, 2 * NODE), words))


def ordered_turns(conversations: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(conv_id, id, _n) of all turns, _n rising along each conversation without gaps, and
    (conv_id, first, own) with the first _n and the number of turns of each conversation."""
    rows = columns(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select(
        F.col("conv_id").cast("long"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ("conv_id", "turn", "role", "text")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    narrow = sorted_rows.select(
        "conv_id", turn_id(F.col("role"), F.col("text")).alias("id"), F.monotonically_increasing_id().alias(POSITION)
    )
    numbered = number_rows(staging.write(narrow, "turns")[0], "_n")
    own = F.count(F.lit(1)).alias("own")
    return numbered, numbered.groupBy("conv_id").agg(F.min("_n").alias("first"), own)


def plain_turns(conversations: DataFrame, staging: Staging) -> DataFrame:
    """(conv_id, place, id, n_turns): the conversations as they are."""
    numbered, each = ordered_turns(conversations, staging)
    return numbered.join(each, "conv_id").select(
        "conv_id", (F.col("_n") - F.col("first")).alias("place"), "id", F.col("own").alias("n_turns")
    )


def reopened_turns(conversations: DataFrame, staging: Staging, group: int = 20, most: int = 3) -> DataFrame:
    """(conv_id, place, id, n_turns): conversations whose first h turns are replaced by those of the
    first conversation of their group of ids; h is crc32(conv_id as text) mod (most + 1).

    A conversation that is left without turns has one row, with null place and id.
    """
    numbered, each = ordered_turns(conversations, staging)
    leads = F.pmod("conv_id", F.lit(group)) == 0
    lent = (
        numbered.where(leads).join(each.where(leads), "conv_id")
        .select("conv_id", (F.col("_n") - F.col("first")).alias("place"), "id").where(F.col("place") < most)
        .groupBy(F.col("conv_id").alias("_base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("_lent"))  # no more than most
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    plan = each.withColumns({"_h": h, "_base": base}).join(lent, "_base", "left")
    taken = F.when(F.col("_lent").isNull(), F.array().cast("array<binary>")).otherwise(
        F.slice(F.transform("_lent", lambda t: t["id"]), F.lit(1), F.col("_h"))
    )
    plan = plan.withColumn("_taken", taken)
    total = F.size("_taken") + F.greatest(F.col("own") - F.col("_h"), F.lit(0))
    plan = plan.select("conv_id", "first", "_h", "_taken", total.cast("long").alias("n_turns"))
    plan, _ = staging.write(plan, "openings")
    narrow = plan.select("conv_id", "first", "_h", F.size("_taken").alias("_borrowed"), "n_turns")
    kept = numbered.join(narrow, "conv_id").where(F.col("_n") - F.col("first") >= F.col("_h"))
    place = F.col("_n") - F.col("first") - F.col("_h") + F.col("_borrowed")
    borrowed = plan.select("conv_id", F.posexplode("_taken").alias("place", "id"), "n_turns")
    bare = plan.where("n_turns = 0").select(
        "conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("id"), "n_turns"
    )
    turns = kept.select("conv_id", place.alias("place"), "id", "n_turns")
    return turns.unionByName(borrowed.withColumn("place", F.col("place").cast("long"))).unionByName(bare)


def _node(prefix: bytes, turns: bytes) -> bytes:
    """The id of the node behind these turns of a block that starts at the node prefix."""
    return hashlib.sha256(prefix + hashlib.sha256(turns).digest()).digest()[:NODE] if turns else prefix


def _node_column(prefix: Column, turns: Column) -> Column:
    inner = F.unhex(F.sha2(turns, 256))
    outer = F.unhex(F.substring(F.sha2(F.concat(prefix, inner), 256), 1, 2 * NODE))
    return F.when(F.octet_length(turns) > 0, outer).otherwise(prefix)


def blocks_of(turns: DataFrame, staging: Staging) -> DataFrame:
    """(conv_id, block, prefix, turns, n_turns): the ids of each block of turns as one string, and
    the node where the block starts. Staged but for the prefixes of long conversations."""
    block = F.coalesce(F.floor(F.col("place") / BLOCK), F.lit(0)).alias("block")
    listed = F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("place", "id"))))
    joined = F.unhex(F.array_join(F.transform(listed, lambda t: F.hex(t["id"])), ""))  # BLOCK ids at most
    blocks = turns.groupBy("conv_id", "n_turns", block).agg(joined.alias("turns"))
    blocks, _ = staging.write(blocks, "blocks")
    full = blocks.where(F.octet_length("turns") == BLOCK * TURN)
    digests = full.select("conv_id", "block", F.unhex(F.sha2("turns", 256)).alias("digest"))
    ordered = digests.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    prefixes = ordered.mapInArrow(_prefixes, "conv_id BIGINT, block BIGINT, prefix BINARY")
    first = blocks.where("block = 0").withColumn("prefix", F.lit(ROOT))
    return first.unionByName(blocks.where("block > 0").join(prefixes, ["conv_id", "block"]))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the digests of a conversation's full blocks, in order, the nodes where they end."""
    conv, prefix = None, ROOT
    for batch in batches:
        ids, numbers = batch.column("conv_id").to_pylist(), batch.column("block").to_pylist()
        found = []
        for own, digest in zip(ids, batch.column("digest").to_pylist()):
            if own != conv:
                conv, prefix = own, ROOT
            prefix = hashlib.sha256(prefix + digest).digest()[:NODE]
            found.append(prefix)
        arrays = [batch.column("conv_id"), pa.array([n + 1 for n in numbers], pa.int64()), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "prefix"])


def _merged(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], min(a[1], b[1]), a[2] + b[2], a[3] + b[3]


LEVELS = "node BINARY, parent BINARY, depth BIGINT, words BIGINT, n BIGINT, conv_id BIGINT, saved BIGINT, leaves BIGINT"


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks over (block, prefix, turns, conv_id, saved, leaves): every node that a block passes, but
    the one where it starts (the root excepted), with the number of blocks, the smallest conv_id and
    the sums below it."""
    kinds = (pa.binary(), pa.binary(), *[pa.int64()] * 6)
    names = ["node", "parent", "depth", "words", "n", "conv_id", "saved", "leaves"]

    def nodes(tree: AdaptiveRadixTree) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for key, start, value in tree.levels(HEAD, TURN):
            block, prefix = int.from_bytes(key[:8], "big"), key[8:HEAD]
            k = max(0, (start - HEAD) // TURN + 1) if start >= 0 else 0
            if k == 0 and block == 0:
                rows.append((ROOT, None, 0, 0, *value))
            above = _node(prefix, key[HEAD : HEAD + (max(k, 1) - 1) * TURN])
            for j in range(max(k, 1), (len(key) - HEAD) // TURN + 1):
                end = HEAD + j * TURN
                here = _node(prefix, key[HEAD:end])
                rows.append((here, above, block * BLOCK + j, int.from_bytes(key[end - 4 : end], "big"), *value))
                above = here
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    tree, held, size = AdaptiveRadixTree(_merged), 0, 0
    for batch in batches:
        for block, prefix, turns, conv, saved, leaves in zip(
            *[batch.column(n).to_pylist() for n in ("block", "prefix", "turns", "conv_id", "saved", "leaves")]
        ):
            tree.put(block.to_bytes(8, "big") + prefix + turns, (1, conv, saved, leaves))
            held, size = held + 1, size + len(turns)
        if held >= KEYS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield from nodes(tree)
            tree, held, size = AdaptiveRadixTree(_merged), 0, 0
    yield from nodes(tree)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (node, conv_id), sorted, as (node, first conv_id, joined conv_ids)."""
    node, ids, rows = None, [], []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*rows)) if rows else [()] * 3
        kinds = (pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, kinds)], ["node", "first", "ids"])

    for batch in batches:
        for own, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if (own != node or len(ids) >= 4096) and ids:
                rows.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = own
            ids.append(conv)
        if len(rows) >= 1000:
            yield batch_of(rows)
            rows = []
    if ids:
        rows.append((node, ids[0], ",".join(map(str, ids))))
    yield batch_of(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's chunks, in order, with commas between them."""
    node, state, rows = None, None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*rows)) if rows else [()] * 2
        return pa.RecordBatch.from_arrays([pa.array(values[0], pa.binary()), pa.array(values[1], pa.string())], ["node", "ends_sha256"])

    for batch in batches:
        for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if own == node:
                state.update(b"," + ids.encode())
                continue
            if state:
                rows.append((node, state.hexdigest()))
            node, state = own, hashlib.sha256(ids.encode())
        if len(rows) >= 1000:
            yield batch_of(rows)
            rows = []
    if state:
        rows.append((node, state.hexdigest()))
    yield batch_of(rows)


def ends_of(blocks: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end. A digest is serial: the ids are
    sorted and joined by many tasks, and one streams the joined runs of a node."""
    last = blocks.where((F.col("block") + 1) * BLOCK >= F.col("n_turns"))
    ends = last.select(_node_column(F.col("prefix"), F.col("turns")).alias("node"), "conv_id")
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = dealt.mapInArrow(_chunks, "node BINARY, first BIGINT, ids STRING")
    met = chunks.repartition("node").sortWithinPartitions("node", "first")
    return met.mapInArrow(_digests, "node BINARY, ends_sha256 STRING")


def build(turns: DataFrame, staging: Staging) -> DataFrame:
    """The nodes of the trie of (conv_id, place, id, n_turns): conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = blocks_of(turns, staging)
    nothing = F.lit(0).cast("long")
    each = blocks.select("block", "prefix", "turns", "conv_id", nothing.alias("saved"), nothing.alias("leaves"))
    nodes = each.mapInArrow(_trees, LEVELS).groupBy("node", "parent", "depth", "words").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs")
    )
    nodes, _ = staging.write(nodes, "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(children, "node", "left").fillna(0, ["n_children"])
    # What a conversation owns ends its path: sums from each node to that end.
    path = Window.partitionBy("conv_id")
    down = path.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = tree.select(
        "node", "parent", "depth", "conv_id", "n_convs", "n_children",
        F.sum((F.col("n_convs") - 1) * F.col("words")).over(down).alias("saved"),
        F.max((F.col("n_children") == 0).cast("long")).over(down).alias("leaves"),
        F.min("depth").over(path).alias("top"),
    )
    owned, _ = staging.write(owned, "owned")
    heads = owned.where((F.col("depth") == F.col("top")) & (F.col("depth") > 0))
    above = F.col("top") - 1 - BLOCK * F.col("block")  # turns of a block that end above what is owned
    passed = (
        blocks.join(heads.select("conv_id", "top", "saved", "leaves"), "conv_id")
        .where((above > 0) | ((F.col("block") == 0) & (above >= 0)))
        .select("block", "prefix", F.expr(f"substring(turns, 1, least(top - 1 - {BLOCK} * block, {BLOCK}) * {TURN})").alias("turns"), "conv_id", "saved", "leaves")
        .mapInArrow(_trees, LEVELS)
        .groupBy("node").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    )
    parents = heads.select("node", "parent").join(
        nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("over")), "parent"
    ).select("node", "over")
    whole = owned.join(passed, "node", "left").join(ends_of(blocks), "node", "left").join(parents, "node", "left")
    same = F.when(F.col("depth") > F.col("top"), F.col("conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id", "depth", F.coalesce("over", same).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
