"""Chat formatting by incremental black-box rendering.

A template is any function from turns (and whether to end with the prompt for an answer) to text.
Nothing about it is known: successive prefixes of the turns are rendered and consecutive outputs
compared. What an output adds to the one before is the span of its turn; an output that does not
begin with the one before shows a template that rewrites history. The text that is learned is
found the same way: behind the output with the answer prompt, and before what the template puts
behind an empty answer.

Turns are put in order by a range sort over all rows and numbered per conversation. A template that
is not known to be local sees every prefix whole, from the first turn on: it may depend on any turn
before, forget the oldest ones or insist on whose turn comes first. Such a conversation is rendered
in one task, whatever its length, and its text is what the template makes of all its turns.

A template that is declared local, as the one of this module, makes of a turn the same text behind
any turns. Long conversations are then spread over many tasks, in blocks of a fixed number of turns,
each behind the last few turns of the block before it, whose own output is taken off. If the output
for a block's first turn changes with fewer turns in front, the declaration is wrong, and the block
counts as rewriting history. Only the digests of a conversation need its blocks one after the
other, as SHA-256 does; they are streamed, never gathered.

Rows are ordered by turn, role and text, nulls first; a null role or text is empty, a null
conv_id a conversation of its own, a repeated row a further turn. A very long text is one turn
like others. An empty table gives no rows. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns
from sparkmart.operators.keys import number_rows, stage_in_order
from sparkmart.staging import Staging

Turn = tuple[str, str]
Template = Callable[[list[Turn], bool], str]

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string is left in it: each `<|` gets a backslash more in between."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_turns(turns: list[Turn], answer: bool = False) -> str:
    """The template of this module: turns between marks, their texts escaped."""
    said = "".join(f"{START}{_role(role)}\n{escape(text)}{END}\n" for role, text in turns)
    return said + (f"{START}assistant\n" if answer else "")


def turns_in(formatted: str) -> list[Turn]:
    """The turns that marked_turns wrote."""
    turns, at = [], 0
    while at < len(formatted):
        line, end = formatted.index("\n", at), formatted.index(END, at)
        if not formatted.startswith(START, at) or line > end:
            raise ValueError(f"no turn begins at character {at}")
        turns.append((_role_back(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def rendered(template: Template, before: list[Turn], turns: list[Turn], learned: str = "assistant"):
    """The text that turns add behind the ones before; per turn its span and that of the text to
    learn (empty for other roles), all relative to this text; whether history is rewritten."""
    base = template(before, False) if before else ""
    last, spans, rewrites = base, [], False
    if before and turns:
        shorter = template(before[1:], False) if before[1:] else ""
        one = template([*before, turns[0]], False)
        fewer = template([*before[1:], turns[0]], False)
        rewrites = one[len(base) :] != fewer[len(shorter) :]
    for k, (role, text) in enumerate(turns):
        prefix = [*before, *turns[:k]]
        now = template([*prefix, (role, text)], False)
        start = len(last) if now.startswith(last) else _common(last, now)
        rewrites |= start < len(last)
        learn = (len(now), len(now))
        if role == learned:
            asked = template(prefix, True)
            empty = template([*prefix, (role, "")], False)
            tail = empty[len(asked) :]
            if now.startswith(asked) and empty.startswith(asked) and now.endswith(tail) and len(now) >= len(asked) + len(tail):
                learn = (len(asked), len(now) - len(tail))
            else:
                rewrites = True
        spans.append(tuple(x - len(base) for x in (start, len(now), *learn)))
        last = now
    return last[len(base) :], spans, rewrites


def _common(a: str, b: str) -> int:
    """How many characters two texts have in common from the start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


SPAN = "struct<start:bigint,end:bigint,learn_start:bigint,learn_end:bigint>"


def format_conversations(
    conversations: DataFrame,
    template: Template = marked_turns,
    block: int = 32,
    context: int = 2,
    staging: Staging | None = None,
    local: bool | None = None,
) -> DataFrame:
    """(conv_id, block, formatted, spans, rewrites): the formatted text of each block of turns,
    with the spans of its turns in it; a conversation's text is that of its blocks in order.

    local declares that the template makes the same text of a turn whatever came before; only the
    module's own template is taken to be so unless told. Otherwise a conversation is one block.
    """
    local = template is marked_turns if local is None else local
    staging = staging or Staging(conversations.sparkSession)
    rows = columns(conversations, "conv_id", "turn", "role", "text")
    ordered, _ = stage_in_order(rows, ("conv_id", "turn", "role", "text"), staging, "turns")
    numbered = number_rows(ordered, "_n")
    firsts = numbered.groupBy(F.col("conv_id").alias("_of")).agg(F.min("_n").alias("_first"))
    placed = numbered.join(firsts, F.col("conv_id").eqNullSafe(F.col("_of"))).select(
        "conv_id",
        (F.col("_n") - F.col("_first")).alias("place"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    own = F.floor(F.col("place") / block) if local else F.lit(0).cast("long")
    # The last turns of a block are also the context of the next.
    goes_to = F.array(own)
    if local:
        goes_to = F.when(F.col("place") % block >= block - context, F.array(own, own + 1)).otherwise(goes_to)
    dealt = placed.select("conv_id", F.explode(goes_to).alias("block"), "place", "role", "text")
    dealt = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, block BIGINT, formatted STRING, spans ARRAY<{SPAN}>, rewrites BOOLEAN"
    arrow = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "learn_start", "learn_end")]))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, found, size = pa.int64(), [], 0

        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.string(), arrow, pa.bool_())
            names = ("conv_id", "block", "formatted", "spans", "rewrites")
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], list(names))

        for (conv, number), turns in _grouped(seen(batches), 2):
            before = [(r, t) for place, r, t in turns if place < number * block]
            here = [(r, t) for place, r, t in turns if place >= number * block]
            if not here:  # the conversation ended with the block before
                continue
            text, spans, rewrites = rendered(template, before, here)
            named = [dict(zip(("start", "end", "learn_start", "learn_end"), s)) for s in spans]
            found.append((conv, number, text, named, rewrites))
            size += len(text)
            if len(found) >= 2000 or size > 4 << 20:
                yield batch_of(found)
                found, size = [], 0
        if found:
            yield batch_of(found)

    return dealt.mapInArrow(render, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from its formatted blocks (of marked_turns): the number of turns,
    the digest of all turns, the characters and digest of the learned text, all characters."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING,"
        " formatted_chars BIGINT, rewrites BOOLEAN"
    )
    blocks = formatted.select("conv_id", "block", "formatted", "spans", "rewrites")
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
        conv, state, done, conv_type = None, None, [], pa.int64()

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), kinds)], names)

        def closed() -> tuple:
            n, turns, chars, learned, size, rewrites = state
            return conv, n, turns.hexdigest(), chars, learned.hexdigest(), size, rewrites

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for own, _, text, spans, rewrites in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or own != conv:
                    if state is not None:
                        done.append(closed())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                turns = turns_in(text)
                state[0] += len(turns)
                state[1].update("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                learned = "".join(unescape(text[s["learn_start"] : s["learn_end"]]) for s in spans)
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
                state[5] |= rewrites
            if len(done) >= 2000:
                yield batch_of(done)
                done = []
        if state is not None:
            done.append(closed())
        if done:
            yield batch_of(done)

    return ordered.mapInArrow(read, schema)
