"""Toxic passages as maximal scoring segments, calibrated by extreme-value statistics.

Learning. Over the distinct labelled texts, (text, word) pairs are counted by label, for words and
for their prefixes of four to six characters. The words of a label are drawn from a distribution
with a symmetric Dirichlet prior, and so are the prefixes of each length; the log-odds of a word are
those of its posterior means. Its score is the bound of their confidence interval that is nearer to
zero: positive for words that are clearly toxic, negative for those that are clearly not and cost
more than a word of which nothing is known, which costs a fixed amount. Words that a prefix would
judge wrongly are in the model too, as words of which nothing is known.

Scanning. All maximal scoring segments of a text are found in one linear scan (Ruzzo and Tompa).
For the clean texts the largest score follows an extreme-value law (Karlin and Altschul): lambda
solves E[exp(lambda s)] = 1 over their words, K is the maximum-likelihood fit to their largest
segments. A segment with a score of S in n words has E = K n exp(-lambda S) chance matches; it is
a passage if E is small. A text's evidence is the sum of -ln E over its passages, or the best -ln E
without any; a logistic curve fitted to the evidence of the labelled texts gives its score.

Counts are summed per task before they are shuffled. Texts are not shuffled while the labels are
few enough to broadcast (their number is checked), and are joined by shuffle beyond. The model has
every node that its thresholds let in. Up to a counted size it is broadcast; a larger one stays a
table, the different words of each slice of texts are looked up in it by shuffle, and each slice is
scored with the scores of its own words. Results are the same.

A null or empty text has no words and gets the score of a text without evidence. Of repeated
labels the highest counts, null labels don't; of equal texts the one with the smallest id is
learned from. Null ids are never labelled and count as not held out. Without labels of both kinds
every score is the share of toxic labels (0.5 without labels), and nothing is a passage. Equal
evidence gives equal scores; a very long text is scanned like others, once; an empty table gives an
empty one. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices, texts_of
from sparkmart.staging import Staging

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PREFIXES = (6, 5, 4)
#: Labels (16 bytes each) up to this number are broadcast to the documents.
BROADCAST_LABELS = 2_000_000
#: Nodes of a model up to this number come to the driver and are broadcast.
BROADCAST_NODES = 400_000


@dataclass(frozen=True)
class Settings:
    least_texts: int = 5  # toxic texts that a scored word is in
    least_score: float = 2.0
    support: int = 20  # texts that an exception to a prefix is in
    confidence: float = 1.64
    neutral: float = 1.0  # what a word without a score costs
    prior: float = 0.5  # of the Dirichlet distribution, for each word
    e_value: float = 0.05


@dataclass
class Model:
    """Scores of nodes (a word, or a prefix with its length), and the calibration."""

    nodes: dict[str, float]
    neutral: float
    e_value: float
    decay: float = 0.0  # lambda; 0: nothing was learned
    k: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0
    table: DataFrame | None = None  # (node, score), of a model too large to be broadcast
    seen: dict[str, float] = field(default_factory=dict)

    def sendable(self, nodes: dict[str, float] | None = None) -> Model:
        """A copy for the tasks, with these nodes or its own."""
        return replace(self, nodes=self.nodes if nodes is None else nodes, table=None, seen={})

    def score(self, word: str) -> float:
        """The score of the longest node that the model has; 0 for a neutral word."""
        found = self.nodes.get(f"0{word}")
        for n in PREFIXES:
            if found is None and len(word) >= n:
                found = self.nodes.get(f"{n}{word[:n]}")
        return found or 0.0

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """Places and scores of the words that have one."""
        seen = self.seen
        if len(seen) > 200_000:
            seen.clear()
        for word in words:
            if word not in seen:
                seen[word] = self.score(word)
        return [(k, seen[w]) for k, w in enumerate(words) if seen[w]]

    def minus_ln_e(self, score: float, n_words: int) -> float:
        return self.decay * score - math.log(self.k * n_words)

    def evidence(self, segments: list[float], n_words: int) -> float:
        if not n_words or not self.decay:
            return LEAST
        least = -math.log(self.e_value)
        each = [self.minus_ln_e(s, n_words) for s in segments] or [self.minus_ln_e(0.0, n_words)]
        strong = [x for x in each if x >= least]
        return min(max(sum(strong) if strong else max(each), LEAST), MOST)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.intercept + self.slope * evidence))))


LEAST, MOST = -25.0, 100.0


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def maximal_segments(hits: list[tuple[int, float]], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, word behind, score) in one scan from the left.

    Each candidate keeps the sums before and behind it, and a link to the last candidate that
    began with a smaller sum, so that the search for the one to merge with skips what it may.
    """
    stack: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, 0
    for place, score in hits:
        total -= neutral * (place - last)
        last = place + 1
        if score < 0:
            total += score
            continue
        first, before, total = place, total, total + score
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                stack.append((first, last, before, total, j))
                break
            first, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, behind - before) for a, b, before, behind, _ in stack]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _node(word: Column, n: int) -> Column:
    return F.concat(F.lit(str(n)), word if n == 0 else F.substring(word, 1, n))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, clean, toxic): in how many texts (text, toxic) of each label a word is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: tuple[Counter, Counter]) -> pa.RecordBatch:
            every = list(found[0].keys() | found[1].keys())
            numbers = [pa.array([c[w] for w in every], pa.int64()) for c in found]
            return pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *numbers], ["word", "clean", "toxic"])

        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for part in slices(batch, "text"):
                for text, toxic in zip(texts_of(part, "text"), part.column("toxic").to_pylist()):
                    found[toxic].update(set(words_of(text)))
                if len(found[0]) > 400_000:
                    yield batch_of(found)
                    found = (Counter(), Counter())
        yield batch_of(found)

    pairs = texts.select("text", "toxic").mapInArrow(count, "word STRING, clean BIGINT, toxic BIGINT")
    return pairs.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learned_nodes(texts: DataFrame, settings: Settings, staging: Staging) -> tuple[DataFrame, int]:
    """(node, score) of all nodes of the model, staged, and their number."""
    words, _ = staging.write(word_counts(texts), "words")
    kinds = F.array(_node(F.col("word"), 0), *[F.when(F.length("word") >= n, _node(F.col("word"), n)) for n in PREFIXES])
    nodes = (
        words.select(F.explode(F.array_compact(kinds)).alias("node"), "clean", "toxic")
        .groupBy("node")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= settings.least_texts)
    )
    nodes, _ = staging.write(nodes, "counts")
    kind = F.substring("node", 1, 1)
    drawn = nodes.groupBy(kind.alias("kind")).agg(
        F.sum("clean").alias("all_clean"), F.sum("toxic").alias("all_toxic"), F.count(F.lit(1)).alias("size")
    )  # one row for words, one for each length of prefixes
    nodes = nodes.withColumn("kind", kind).join(F.broadcast(drawn), "kind")
    a, b, prior = F.col("toxic") + settings.prior, F.col("clean") + settings.prior, settings.prior * F.col("size")
    odds = F.log(a / (F.col("all_toxic") + prior)) - F.log(b / (F.col("all_clean") + prior))
    error = settings.confidence * F.sqrt(1 / a + 1 / b)
    clear = (F.col("toxic") >= settings.least_texts) & (odds - error >= settings.least_score)
    score = F.when(clear, odds - error).when(odds + error <= -settings.neutral, odds + error).otherwise(0.0)
    seen = F.col("clean") + F.col("toxic")
    nodes, _ = staging.write(nodes.select("node", seen.alias("texts"), score.alias("score")), "nodes")
    # Nodes that have been seen often enough and say nothing, below a prefix that does.
    heads = [_node(F.substring("node", 2, 1000), n) for n in PREFIXES]
    longer = [F.when((F.substring("node", 1, 1) == "0") | (F.length("node") - 1 > n), h) for n, h in zip(PREFIXES, heads)]
    plain = nodes.where((F.col("texts") >= settings.support) & (F.col("score") == 0))
    apart = (
        plain.select("node", F.explode(F.array_compact(F.array(*longer))).alias("prefix"))
        .join(nodes.where("score <> 0").select(F.col("node").alias("prefix")), "prefix", "left_semi")
        .select("node").distinct().select("node", F.lit(0.0).alias("score"))
    )
    whole = nodes.where("score <> 0").select("node", "score").unionByName(apart)
    whole, seen = staging.write(whole, "model", {"n": F.count(F.lit(1))})
    return whole, seen["n"]


def over_slices(
    rows: DataFrame, model: Model, work: Callable[[pa.RecordBatch, Model], pa.RecordBatch], schema: str, staging: Staging
) -> DataFrame:
    """work of slices of rows, whose last column is text, with a model that scores their words."""
    if model.table is None:
        sent = rows.sparkSession.sparkContext.broadcast(model.sendable())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    yield work(part, sent.value)

        return rows.mapInArrow(run, schema)
    plain, names = model.sendable({}), rows.columns

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.append_column("_slice", pa.array(np.full(part.num_rows, number, np.int64)))
                number += 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, set[str]] = {}
            for number, text in zip(batch.column("_slice").to_pylist(), texts_of(batch, "text")):
                found.setdefault(number, set()).update(words_of(text))
            for number, words in found.items():
                arrays = [pa.array(np.full(len(words), number, np.int64)), pa.array(list(words), pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["_slice", "word"])

    def scored(texts: pa.Table, known: pa.Table) -> pa.Table:
        words = zip(known.column("word").to_pylist(), known.column("score").to_pylist())
        own = plain.sendable({f"0{word}": score for word, score in words})
        return pa.Table.from_batches([work(part, own) for part in texts.select(names).combine_chunks().to_batches()])

    sliced = rows.mapInArrow(numbered, ", ".join(f"`{n}` {k}" for n, k in rows.dtypes) + ", _slice BIGINT")
    sliced, _ = staging.write(sliced, f"slices-{uuid.uuid4().hex}")
    asked = sliced.select("_slice", "text").mapInArrow(listed, "_slice BIGINT, word STRING").distinct()
    ways = [F.struct(F.lit(0).alias("way"), _node(F.col("word"), 0).alias("node"))] + [
        F.when(F.length("word") >= n, F.struct(F.lit(k).alias("way"), _node(F.col("word"), n).alias("node")))
        for k, n in enumerate(PREFIXES, 1)
    ]
    words = asked.select("word").distinct()
    nodes = words.select("word", F.explode(F.array_compact(F.array(*ways))).alias("way")).select("word", "way.*")
    scores = nodes.join(model.table, "node").groupBy("word").agg(F.min_by("score", "way").alias("score")).where("score <> 0")
    known = asked.join(scores, "word").select("_slice", "word", "score")
    return sliced.groupBy("_slice").cogroup(known.groupBy("_slice")).applyInArrow(scored, schema)


def solved_decay(counts: dict[float, int], n_words: int, neutral: float) -> float:
    """The positive lambda with E[exp(lambda s)] = 1 over the words of clean texts."""
    rest = n_words - sum(counts.values())
    if not any(s > 0 for s in counts):
        counts = {**counts, 6.0: 1}  # no word of a clean text speaks for toxic: as if one had

    def excess(x: float) -> float:
        return sum(n * math.exp(x * s) for s, n in counts.items()) + rest * math.exp(-x * neutral) - n_words

    mean = sum(s * n for s, n in counts.items()) - rest * neutral
    if mean >= 0:
        return 0.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def fitted_logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of the odds of toxic over evidence, from (evidence, clean, toxic): Newton's
    steps, halved until the likelihood rises."""
    x, clean, toxic = (np.array(v, float) for v in zip(*rows))
    design = np.stack([np.ones_like(x), x])

    def loss(beta: np.ndarray) -> float:
        odds = beta @ design
        return float(toxic @ np.logaddexp(0, -odds) + clean @ np.logaddexp(0, odds) + 5e-4 * beta @ beta)

    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -50, 50)))
        gradient = design @ (toxic * (1 - p) - clean * p) - 1e-3 * beta
        weight = (toxic + clean) * p * (1 - p) + 1e-9
        step = np.linalg.solve((design * weight) @ design.T + 1e-3 * np.eye(2), gradient)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        beta = beta + step
    return float(beta[0]), float(beta[1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    staging: Staging | None = None,
    broadcast_labels: int = BROADCAST_LABELS,
    broadcast_nodes: int = BROADCAST_NODES,
) -> Model:
    """A model from the documents (doc_id, text) that labels (doc_id, toxic) has and that are not held out."""
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    docs = columns(docs, "doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    labels = columns(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashes = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    firsts = hashes.join(labels, "doc_id").groupBy("a", "b").agg(F.min(F.struct("doc_id", "toxic")).alias("first"))
    firsts, seen = staging.write(
        firsts.select("first.*"), "labels",
        {"n": F.count(F.lit(1)), "toxic": F.coalesce(F.sum("toxic"), F.lit(0))},
    )
    n_clean, n_toxic = seen["n"] - seen["toxic"], seen["toxic"]
    base = n_toxic / seen["n"] if seen["n"] else 0.5
    if not n_clean or not n_toxic:
        odds = math.log(max(base, 1e-300) / max(1 - base, 1e-300))
        return Model({}, settings.neutral, settings.e_value, intercept=odds)
    known = F.broadcast(firsts) if seen["n"] <= broadcast_labels else firsts
    texts = docs.join(known, "doc_id").select("toxic", "text")
    nodes, size = learned_nodes(texts, settings, staging)
    if size <= broadcast_nodes:
        model = Model({r.node: r.score for r in nodes.collect()}, settings.neutral, settings.e_value)
    else:
        model = Model({}, settings.neutral, settings.e_value, table=nodes)
    found, _ = staging.write(_segments(texts, model, staging), "segments")
    clean = found.where("toxic = 0 AND n_words > 0")
    scores = clean.select(F.explode("hits").alias("s")).groupBy("s").count().collect()  # quarters: a few dozen
    n_words = clean.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    model.decay = solved_decay({r.s: r["count"] for r in scores}, max(n_words, 1), model.neutral)
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    chance = clean.agg(F.count(F.lit(1)), F.sum(F.col("n_words") * F.exp(-model.decay * best))).first()
    if chance[0] and chance[1]:
        model.k = chance[0] / chance[1]
    # Evidence as in Model.evidence, in steps of a quarter.
    each = F.transform(
        F.when(F.size("segments") > 0, F.col("segments")).otherwise(F.array(F.lit(0.0))),
        lambda s: s * model.decay - F.log(F.lit(model.k) * F.col("n_words")),
    )
    least = -math.log(model.e_value)
    strong = F.aggregate(F.filter("each", lambda x: x >= least), F.lit(0.0), lambda a, x: a + x)
    value = F.when(F.array_max("each") >= least, strong).otherwise(F.array_max("each"))
    value = F.when(F.col("n_words") == 0, F.lit(LEAST)).otherwise(value)
    value = F.greatest(F.least(value, F.lit(MOST)), F.lit(LEAST))
    steps = found.withColumn("each", each).groupBy((F.round(value * 4) / 4).alias("x")).agg(
        F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")
    )
    model.intercept, model.slope = fitted_logistic([tuple(r) for r in steps.collect()])  # (MOST - LEAST) * 4 rows at most
    return model


def _segments(texts: DataFrame, model: Model, staging: Staging) -> DataFrame:
    """Per labelled text: its words, the scores of its segments and of its scored words (quarters)."""

    def work(part: pa.RecordBatch, model: Model) -> pa.RecordBatch:
        rows = []
        for text, toxic in zip(texts_of(part, "text"), part.column("toxic").to_pylist()):
            words = words_of(text)
            hits = model.hits(words)
            segments = [s for _, _, s in maximal_segments(hits, model.neutral)]
            rows.append((toxic, len(words), segments, [round(4 * s) / 4 for _, s in hits]))
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["toxic", "n_words", "segments", "hits"]
        )

    return over_slices(texts, model, work, "toxic INT, n_words BIGINT, segments ARRAY<DOUBLE>, hits ARRAY<DOUBLE>", staging)


PASSAGE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])


def score(docs: DataFrame, model: Model, staging: Staging | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, and the passages as half-open
    ranges of characters of the lower-cased text, with segment score and chance matches."""
    docs = columns(docs, "doc_id", "text").select("doc_id", held_out("doc_id").alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out BOOLEAN, score DOUBLE, predicted INT, n_words BIGINT,"
        " passages ARRAY<STRUCT<start: BIGINT, end: BIGINT, score: DOUBLE, e_value: DOUBLE>>"
    )

    def judged(text: str, model: Model) -> tuple:
        words = words_of(text)
        segments = maximal_segments(model.hits(words), model.neutral) if model.decay else []
        evidence = model.evidence([s for _, _, s in segments], len(words))
        chance = [(a, b, s, math.exp(-model.minus_ln_e(s, len(words)))) for a, b, s in segments]
        passages = [x for x in chance if x[3] <= model.e_value]
        if passages:
            places = [m.span() for m in WORD.finditer(text.lower())]
            passages = [(places[a][0], places[b - 1][1], s, e) for a, b, s, e in passages]
        p = model.probability(evidence)
        return p, int(p >= 0.5), len(words), [dict(zip(("start", "end", "score", "e_value"), x)) for x in passages]

    def work(part: pa.RecordBatch, model: Model) -> pa.RecordBatch:
        rows = zip(*[judged(text, model) for text in texts_of(part, "text")])
        kinds = (pa.float64(), pa.int32(), pa.int64(), pa.list_(PASSAGE))
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *[pa.array(x, t) for x, t in zip(rows, kinds)]],
            ["doc_id", "held_out", "score", "predicted", "n_words", "passages"],
        )

    return over_slices(docs, model, work, schema, staging or Staging(docs.sparkSession))
