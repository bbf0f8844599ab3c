"""The pipeline against the brute force of each stage, over the smallest tables."""

from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import TABLES
from sparkmart.llm import line_dedup
from llm.test_decontaminate import brute as contamination
from llm.test_order_minhash import brute as near
from llm.test_quality_rules import brute as quality


def kept_lines(rows):
    """Rows (doc_id, source, text) without lines on too many of a source's pages."""
    rules = line_dedup.BoilerplateRules()
    pages, lines = Counter(), Counter()
    for _, source, text in rows:
        pages[source] += 1
        lines.update({(source, x.strip(" \t\r")) for x in text.split("\n")})
    out = []
    for doc, source, text in rows:
        def drop(x):
            n = lines[source, x.strip(" \t\r")]
            return bool(x.strip(" \t\r")) and n >= rules.min_pages and n > rules.ratio * pages[source]

        left = [x for x in text.split("\n") if not drop(x)]
        whole = not any(x.strip(" \t\r") for x in left)
        out.append((doc, source, text if whole else "\n".join(left)))
    return out


def test_run(spark):
    docs = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    docs = kept_lines([d for d in docs if quality(d[2])[-1]])
    firsts = {c for _, c, _ in near([(d, t) for d, _, t in docs])}
    docs = [d for d in docs if d[0] in firsts]
    bad = {r[0] for r in contamination([(d, t) for d, _, t in docs], items) if r[-1]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, _, t in docs if d not in bad}
    found = corpus_pipeline.run(spark, TABLES).toPandas()
    assert found.groupby("doc_id").length.sum().to_dict() == sizes
    assert found.groupby("sequence_id").length.sum().max() <= 4096
    assert found.sequence_id.nunique() <= np.ceil(sum(sizes.values()) / 4096) + 1


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, TABLES).columns == docs.columns
        assert stage(spark, empty, TABLES).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, TABLES).count() == 0
