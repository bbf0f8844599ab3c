"""Secret scan with an inverted trigram index; DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams follows: trigrams that every
match must contain. A text is indexed in one pass: one regular expression, a tree of all trigrams
that some query asks for, looks at each place of the text, folded to lower case, and gives the
postings, the different trigrams that occur. They stay beside the text in its row; there the
conjunctions of the queries are intersected with them, and a rule's regular expression runs on
the texts that satisfy its query and on no others. A rule without a mandatory trigram runs on all
texts. Nothing is shuffled, so no trigram, id or text makes a group. postings() gives the index as
(trigram, row) for searches that start from a trigram.

Spans are half-open ranges of code points: leftmost, non-overlapping per rule. Where they begin is
summed up in chunks of CHUNK matches, so the work grows with the number of matches of a text,
however many. A null text is empty and has no spans; an empty table gives an empty one. Repeated
rows each give a result; null ids are rows like others. Spans of different rules may overlap, and
of two that start together the rule listed first comes first. Other columns, whatever their names,
go no further.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches count if their group is long enough."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The kinds of secrets.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # as AKIA[A-Z0-9]+ of 20 or more: runs end where they end
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,250}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~-]+:[^\s/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that a part of a pattern may stand for before it counts as unknown.
MOST_STRINGS = 24
#: Matches whose places are summed up at a time.
CHUNK = 128


Conjunctions = list[frozenset[str]]
ANY: Conjunctions = [frozenset()]


def trigram_query(pattern: str) -> Conjunctions:
    """Conjunctions of lower-case trigrams, one of which every match satisfies.

    An empty list: the pattern has matches without a mandatory trigram.
    """
    exact, query = _analysed(re._parser.parse(pattern))
    query = query if exact is None else _holding(exact)
    least = [c for c in query if not any(o < c for o in query)]
    return [] if frozenset() in least else sorted(set(least), key=sorted)


def _holding(strings: set[str]) -> Conjunctions:
    """What holds for a text with one of these strings in it."""
    found = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings}
    return ANY if frozenset() in found else list(found)


def _and(a: Conjunctions, b: Conjunctions) -> Conjunctions:
    """Both hold; or only a, which is weaker and so still right, if that were too long."""
    return [x | y for x, y in product(a, b)] if len(a) * len(b) <= MOST_STRINGS**2 else a


def _analysed(parsed) -> tuple[set[str] | None, Conjunctions]:
    """All strings that a parsed pattern stands for, if they are known and few; else None and
    what must hold for its matches. Adjacent known parts are joined before they are cut up."""
    query, tail, exact = ANY, {""}, True
    for name, value in parsed:
        known, inner = _part(str(name), value)
        if known is not None and len(known) * len(tail) <= MOST_STRINGS:
            tail = {a + b for a, b in product(tail, known)}
            continue
        query, exact = _and(query, _holding(tail)), False
        tail = {""} if known is None else known
        query = _and(query, inner)
    return (tail, ANY) if exact else (None, _and(query, _holding(tail)))


def _part(name: str, value) -> tuple[set[str] | None, Conjunctions]:
    if name == "LITERAL":
        return {chr(value).lower()}, ANY
    if name == "AT":
        return {""}, ANY
    if name == "SUBPATTERN":
        return _analysed(value[-1])
    if name == "IN" and all(str(n) in ("LITERAL", "RANGE") for n, _ in value):
        ranges = [(v, v) if str(n) == "LITERAL" else v for n, v in value]
        if sum(b - a + 1 for a, b in ranges) <= MOST_STRINGS:
            return {chr(c).lower() for a, b in ranges for c in range(a, b + 1)}, ANY
    if name == "BRANCH":
        parts = [_analysed(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in parts):
            return set().union(*[exact for exact, _ in parts]), ANY
        return None, [c for exact, inner in parts for c in (inner if exact is None else _holding(exact))]
    if name == "MAX_REPEAT":
        least, most, inner = value
        exact, held = _analysed(inner)
        if most == 1 and exact is not None:
            return exact if least else exact | {""}, ANY
        if least:
            return None, held if exact is None else _holding(exact)
    return None, ANY


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _quoted(character: str) -> str:
    return character if character.isalnum() and character.isascii() else f"\\x{{{ord(character):x}}}"


def trigram_tree(trigrams: list[str]) -> str:
    """A regular expression that finds each of the trigrams at each place where it begins."""
    firsts: dict[str, dict[str, list[str]]] = {}
    for a, b, c in sorted(set(trigrams)):
        firsts.setdefault(a, {}).setdefault(b, []).append(c)
    branches = []
    for a, seconds in firsts.items():
        ends = [f"{_quoted(b)}[{''.join(map(_quoted, thirds))}]" for b, thirds in seconds.items()]
        branches.append(f"{_quoted(a)}(?:{'|'.join(ends)})")
    return f"(?=({'|'.join(branches)}))"


def asked_for(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams in the queries of the rules."""
    return sorted({g for rule in rules for conjunction in trigram_query(rule.pattern) for g in conjunction})


def posted(text: Column, trigrams: list[str]) -> Column:
    """The different ones of the trigrams that a text has, folded, found in one pass."""
    if not trigrams:
        return F.array().cast("array<string>")
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(trigram_tree(trigrams)), F.lit(1)))


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(trigram, row): the index of all texts for these trigrams, a row named by row_key."""
    found = F.explode(posted(F.coalesce(F.col(text_col), F.lit("")), trigrams))
    return columns(docs, id_col, text_col).select(found.alias("trigram"), row_key(id_col, text_col).alias("row"))


def satisfied(rule: Rule, found: Column) -> Column:
    """Whether the postings of a text satisfy the rule's query."""
    query = [[g for g in sorted(conjunction)] for conjunction in trigram_query(rule.pattern)]
    if not query:
        return F.lit(True)
    wanted = F.array(*[F.array(*map(F.lit, conjunction)) for conjunction in query])
    return F.exists(wanted, lambda c: F.forall(c, lambda g: F.array_contains(found, g)))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text: positions are running sums of gaps and matches.

    A running sum over an array copies what it has at each step. So it is taken in chunks, then over
    the totals of the chunks.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    zipped = [gaps.alias("gap"), hits.alias("hit")]
    if rule.group:
        zipped.append(F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("value"))
    parts = F.transform(
        F.arrays_zip(*zipped),
        lambda x: F.struct(
            x["gap"].alias("gap"),
            F.coalesce(x["hit"], F.lit(0)).alias("hit"),
            F.coalesce(x["value" if rule.group else "hit"] >= rule.least, F.lit(False)).alias("long"),
        ),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["hit"]
        found = F.struct(start.alias("start"), end.alias("end"), x["long"].alias("long"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(found)).alias("found"))

    none = F.array().cast("array<struct<start:int,end:int,long:boolean>>")
    first = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def chunked(parts: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, lambda k: F.aggregate(F.slice(parts, k * CHUNK + 1, F.lit(CHUNK)), first, step))

    def whole(acc: Column, chunk: Column) -> Column:
        moved = F.transform(
            F.filter(chunk["found"], lambda s: s["long"]),
            lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")),
        )
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["found"], F.array(moved)).alias("found"))

    lists = F.array().cast("array<array<struct<start:int,end:int>>>")
    start = F.struct(F.lit(0).alias("at"), lists.alias("found"))
    return F.flatten(F.aggregate(bound(parts, chunked), start, whole, lambda acc: acc["found"]))


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: the id and spans, an array of (start, kind number, end, kind)
    in this order; kinds are numbered as the rules are listed."""
    docs = columns(docs, id_col, text_col)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("postings", posted(F.col("text"), asked_for(rules)))
    none = F.array().cast("array<struct<start:int,end:int>>")
    kinds = []
    for number, rule in enumerate(rules):
        spans = F.when(satisfied(rule, F.col("postings")), spans_of(F.col("text"), rule)).otherwise(none)
        kinds.append(F.transform(spans, _named(number, rule.kind)))
    return rows.select(F.col(id_col), F.array_sort(F.concat(*kinds)).alias("spans"))


def _named(number: int, kind: str):
    def named(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind")
        )

    return named
