from __future__ import annotations

import math
import random
import re
import zlib

import pytest

from sparkmart.llm import toxicity
from sparkmart.llm.toxicity import Model, learn, maximal_segments, score
from sparkmart.staging import Staging


def brute_segments(scores):
    """All maximal segments by their definition: the best segment, then the same on both sides."""
    if not scores or max(scores) <= 0:
        return []
    best = max(
        ((a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        key=lambda s: (round(sum(scores[s[0] : s[1]]), 9), s[0] - s[1]),
    )
    a, b = best
    right = [(x + b, y + b) for x, y in brute_segments(scores[b:])]
    return [*brute_segments(scores[:a]), (a, b), *right]


def test_segments_by_definition():
    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([-1.0, -1.0, -2.6, 0.7, 2.3, 4.1]) for _ in range(rng.randrange(14))]
        hits = [(k, s) for k, s in enumerate(scores) if s != -1]
        found = maximal_segments(hits, 1.0)
        assert [(a, b) for a, b, _ in found] == brute_segments(scores)
        for a, b, total in found:
            assert total == pytest.approx(sum(scores[a:b]))


def rows(n, seed):
    rng = random.Random(seed)
    out, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.25
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 120))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), f"nasty{rng.randrange(60)}")
        out.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return out, labels


def test_held_out_documents(sent, docs, fresh):
    texts, labels = rows(1500, 4)
    extra = [(9001, None), (9002, ""), (None, "nasty1 nasty2 nasty3"), (7, texts[7][1]), (9003, "w1 " * 50_000 + "nasty7 NASTY8, nasty9!")]
    marks = sent.createDataFrame([*labels, (1, None), (None, 1), (9001, 0), labels[3]], "doc_id LONG, toxic INT")
    model = learn(docs(texts + extra), marks, staging=fresh)
    found = score(docs(texts + extra), model).collect()
    assert len(found) == len(texts) + len(extra)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in found}
    assert by[9001].score == by[9002].score < 0.5 and by[None].score > 0.5 and not by[None].held_out
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    long = extra[-1][1]
    assert [long[p.start : p.end] for p in by[9003].passages] == ["nasty7 NASTY8, nasty9"]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def brute_nodes(texts, settings):
    """Every node of the model from (text, toxic), by the formulas of the module's description."""
    counts = {}
    for text, toxic in texts:
        for word in set(plain_words(text)):
            for n in (0, *toxicity.PREFIXES):
                if len(word) >= n:
                    counts.setdefault(f"{n}{word[:n] if n else word}", [0, 0])[toxic] += 1
    counts = {k: c for k, c in counts.items() if sum(c) >= settings.least_texts}
    scores = {}
    for node, (clean, toxic) in counts.items():
        own = [c for k, c in counts.items() if k[0] == node[0]]
        a, b = toxic + settings.prior, clean + settings.prior
        odds = math.log(a / (sum(c[1] for c in own) + settings.prior * len(own))) - math.log(
            b / (sum(c[0] for c in own) + settings.prior * len(own))
        )
        error = settings.confidence * math.sqrt(1 / a + 1 / b)
        scores[node] = 0.0
        if toxic >= settings.least_texts and odds - error >= settings.least_score:
            scores[node] = odds - error
        elif odds + error <= -settings.neutral:
            scores[node] = odds + error
    kept = {k: s for k, s in scores.items() if s}
    for node in scores:
        if not scores[node] and sum(counts[node]) >= settings.support:
            above = [f"{n}{node[1:][:n]}" for n in toxicity.PREFIXES if node[0] == "0" or len(node) - 1 > n]
            if any(scores.get(a) for a in above):
                kept[node] = 0.0
    return kept


def brute_evidence(words, model):
    def score_of(word):
        for n in (0, *toxicity.PREFIXES):
            node = f"{n}{word[:n] if n else word}"
            if len(word) >= n and node in model.nodes:
                return model.nodes[node] or -model.neutral
        return -model.neutral

    scores = [score_of(w) for w in words]
    if not words:
        return -25.0, scores, []
    best = [sum(scores[a:b]) for a, b in brute_segments(scores)]
    each = [model.decay * s - math.log(model.k * len(words)) for s in best or [0.0]]
    strong = [x for x in each if x >= -math.log(model.e_value)]
    return min(max(sum(strong) if strong else max(each), -25.0), 100.0), scores, best


def small_rows():
    rng = random.Random(12)
    texts, labels = [], []
    for k in range(900):
        toxic = rng.random() < 0.3
        words = [rng.choice(["calm", "tree", "river", "stone", "mild"]) for _ in range(rng.randrange(3, 9))]
        if toxic:
            words[1:1] = [rng.choice(["vileness", "vilest", "nasty", "cruelly"]) for _ in range(rng.randrange(1, 3))]
        else:
            words += rng.sample(["kindly", "kindness", "garden", "vilemont", "tree"], rng.randrange(4))
            words += ["vilest"] * (rng.random() < 0.015)
        if rng.random() < 0.02:
            words.append("nastygram")
        texts.append((k, " ".join(words) + f" only{k}"))
        labels.append((k, int(toxic)))
    return texts, labels


def test_against_brute_force(sent, docs, fresh):
    """Model, calibration and scores of every text, by the definitions."""
    texts, labels = small_rows()
    texts += [(2001, texts[3][1]), (2002, None), (2003, "")]  # an equal text; without labels
    marks = sent.createDataFrame(labels, "doc_id LONG, toxic INT")
    settings = toxicity.Settings(support=8)
    model = learn(docs(texts), marks, settings, staging=fresh)
    held = {k for k, _ in texts if zlib.crc32(str(k).encode()) % 5 == 0}
    firsts = {}
    for k, toxic in labels:
        if k not in held:
            firsts.setdefault(texts[k][1], toxic)
    nodes = brute_nodes(list(firsts.items()), settings)
    assert model.nodes == pytest.approx(nodes) and min(nodes.values()) < -1 < 0 < max(nodes.values())
    assert 0.0 in nodes.values()  # a word below a prefix that says more than it does
    seen = [(toxic, plain_words(text), *brute_evidence(plain_words(text), model)) for text, toxic in firsts.items()]
    clean = [(words, scores, best) for toxic, words, _, scores, best in seen if not toxic]
    drawn = [s if s == -model.neutral else round(4 * s) / 4 for _, scores, _ in clean for s in scores]
    assert sum(math.exp(model.decay * s) for s in drawn) == pytest.approx(len(drawn), rel=1e-6)
    assert model.k == pytest.approx(len(clean) / sum(len(w) * math.exp(-model.decay * max(best, default=0)) for w, _, best in clean))
    steps = [(toxic, round(4 * x) / 4) for toxic, _, x, _, _ in seen]
    p = [1 / (1 + math.exp(-model.intercept - model.slope * x)) for _, x in steps]
    assert sum(t - q for (t, _), q in zip(steps, p)) == pytest.approx(1e-3 * model.intercept, abs=1e-2)
    assert sum((t - q) * x for (t, x), q in zip(steps, p)) == pytest.approx(1e-3 * model.slope, abs=1e-1)
    found = sorted((r.doc_id, r.score, r.predicted) for r in score(docs(texts), model).collect())
    expected = [(k, model.probability(brute_evidence(plain_words(t), model)[0])) for k, t in texts]
    assert [f[:2] for f in found] == [(k, pytest.approx(x)) for k, x in sorted(expected)]


def test_a_model_too_large_to_be_broadcast(sent, docs, fresh):
    """Words are looked up by shuffle then, with the same results."""
    texts, labels = small_rows()
    texts += [(3001, "vilest nasty " * 3000), (3002, None), (3003, "vilest, vilest")]
    marks = sent.createDataFrame(labels, "doc_id LONG, toxic INT")
    small = learn(docs(texts), marks, staging=fresh)
    large = learn(docs(texts), marks, staging=Staging(sent, fresh.folder), broadcast_nodes=0)
    assert large.nodes == {} and large.table.count() == len(small.nodes)
    assert (large.decay, large.k, large.slope) == pytest.approx((small.decay, small.k, small.slope))
    a, b = score(docs(texts), small).collect(), score(docs(texts), large).collect()
    key = [sorted((r.doc_id, r.predicted, r.n_words, [p.start for p in r.passages]) for r in rows) for rows in (a, b)]
    assert key[0] == key[1] and len(a) == len(texts)
    assert sorted(r.score for r in a) == pytest.approx(sorted(r.score for r in b))


def test_shuffled_labels_give_the_same_model(sent, docs, fresh):
    texts, labels = rows(400, 8)
    marks = sent.createDataFrame(labels, "doc_id LONG, toxic INT")
    a, b = learn(docs(texts), marks), learn(docs(texts), marks, broadcast_labels=0)
    assert (a.nodes, a.k, a.slope) == (b.nodes, pytest.approx(b.k), pytest.approx(b.slope))


@pytest.mark.parametrize(("labels", "expected"), [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_nothing_to_learn(sent, docs, labels, expected):
    marks = sent.createDataFrame(labels, "doc_id LONG, toxic INT")
    model = learn(docs([(1, "a"), (2, "b"), (3, None)]), marks)
    assert [(r.score, r.passages) for r in score(docs([(1, "a b"), (2, None)]), model).collect()] == [(pytest.approx(expected), [])] * 2
    assert score(docs([]), model).count() == 0


def test_exceptions_outdo_prefixes():
    model = Model({"5nasty": 4.0, "0nastyish": 0.0}, 1.0, 0.05)
    assert [model.score(w) for w in ("nasty", "nastyx", "nastyish", "nast")] == [4.0, 4.0, 0.0, 0.0]
    assert toxicity.words_of("It's A1 É") == ["it", "s", "a1", "é"]
