from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkmart.llm.line_dedup import BoilerplateRules, drop_boilerplate, host_of

RULES = BoilerplateRules(ratio=0.3, min_pages=3)


def brute(rows, keep_emptied):
    pages, lines = {}, {}
    for host, text in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            lines[host, line] = lines.get((host, line), 0) + 1
    out = []
    for host, text in rows:
        every = text.split("\n") if text is not None else []
        gone = [lines.get((host, x.strip(" \t\r")), 0) for x in every]
        bad = [n >= 3 and n > 0.3 * pages[host] for n in gone]
        left = [x for x, b in zip(every, bad) if not b]
        if keep_emptied and any(bad) and not any(x.strip(" \t\r") for x in left):
            bad, left = [False] * len(every), every
        out.append((host, "\n".join(left) if text is not None else None, len(every), sum(bad)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(9)
    lines = ["menu", " menu\t", "footer é", "", "  ", "one", "two", "three", "four\r", "five"]
    rows = [(rng.choice(["a", "a", "b", None]), "\n".join(rng.choice(lines) for _ in range(rng.randrange(6)))) for _ in range(60)]
    return rows + [("a", None), (None, None), ("c", "menu"), ("d", "same\nlines")] + [("e", "same\nlines")] * 4 + [("a", "menu\n" * 30_000)]


@pytest.mark.parametrize("broadcast_lines", [0, 1000])
@pytest.mark.parametrize("keep_emptied", [False, True])
def test_against_brute_force(sent, fresh, broadcast_lines, keep_emptied):
    rows = cases()
    frame = sent.createDataFrame([(*r, 1, "l", k) for k, r in enumerate(rows)], "source STRING, text STRING, every LONG, lines STRING, host LONG")
    cut = drop_boilerplate(frame, F.col("source"), "text", RULES, keep_emptied, fresh, broadcast_lines)
    assert cut.columns == [*frame.columns, "_n_lines", "_n_dropped"]
    found = sorted([(r.source, r.text, r._n_lines, r._n_dropped) for r in cut.collect()], key=repr)
    assert found == brute(rows, keep_emptied)


def test_native_plan(docs):
    plan = drop_boilerplate(docs([(1, "x")]), F.col("source"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(docs):
    assert drop_boilerplate(docs([]), F.col("source")).count() == 0


def test_hosts(sent):
    urls = ["http://A.example:80/x", "https://u:p@b.org?q", "no url", None, "ftp://c#f"]
    found = sent.createDataFrame([(u,) for u in urls], "u STRING").select(host_of(F.col("u"))).collect()
    assert [r[0] for r in found] == ["a.example", "b.org", "", "", "c"]
