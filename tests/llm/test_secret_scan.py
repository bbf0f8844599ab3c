from __future__ import annotations

import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm.secret_scan import BASE_RULES, RULES, Rule, asked_for, postings, row_key, scan, trigram_query

HEX = "0123456789abcdef" * 3
CASES = [
    None, "", "password=hunter22 PassWord : 'abc' api_key=\"ABCdef123\" apikey:abcdef token = x",
    "token=token: abcdefg secret=secret=abcdefgh passwd  =  'zz/+=.-_zz'", f"AKIA{'A' * 15} AKIA{'B' * 16}x AKIAAKIA{'C' * 20}",
    f"é{HEX}é {HEX[:23]} {HEX[:24]}g{HEX}", "ſecret=abcdefgh toKen=abcdefgh Key api_Key=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY----- -----BEGIN PRIVATE KEY-----", f"ghp_{'a' * 36} gho_{'b' * 35} xoxb-{'1' * 12}",
    "https://user:pa55@host/ ftp://x@y http://a.b:80/", f"日本{HEX}\npassword:日本 password: abcdef\r\n", "x" * 100_000 + f" token:{HEX}",
]


def brute(text):
    text, found = text or "", []
    for number, rule in enumerate(RULES):
        pattern = re.compile(rule.pattern, re.ASCII)
        for m in pattern.finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), number, m.end(), rule.kind))
    return sorted(found)


def ascii_only(text):
    """Java folds case in ASCII alone; Python's re would also take these for s and k."""
    return text and text.replace("ſ", "ā").replace("K", "ā")


def test_against_plain_expressions(docs):
    rng = random.Random(1)
    parts = ["password", "API_KEY", "=", ": ", "'", "token", "AKIA", HEX[:20], "A1B2C3D4E5F6", " ", "é", "secret", "://", "u:p@"]
    texts = CASES + ["".join(rng.choice(parts) for _ in range(rng.randrange(2, 30))) for _ in range(150)]
    rows = [*enumerate(texts), (None, "secret=abcdefgh"), (2, CASES[2]), (2, "another text, one id")]
    found = sorted([(r.doc_id, [tuple(s) for s in r.spans]) for r in scan(docs(rows)).collect()], key=repr)
    assert found == sorted([(k, brute(ascii_only(t))) for k, t in rows], key=repr)


def test_base_rules_as_stated():
    """access and hex say the length in the pattern; that finds what the open patterns find."""
    stated = [(r"AKIA[A-Z0-9]+", 20), (r"[0-9a-f]+", 24)]
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice(["AKIA", "Z9", "0a", "f" * 9, " ", "g"]) for _ in range(40))
        for rule, (pattern, least) in zip(BASE_RULES[1:], stated):
            long = [m.span() for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
            assert [m.span() for m in re.finditer(rule.pattern, text)] == long


PIECES = st.sampled_from(["abc", "[xy]", "(foo|ba)", "d?", "(qrs)+", "[a-z]*", "\\d", "(?:uv|wxyz)?", "e", "."])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=7), st.text(alphabet="abcxyfoqrsduvwz1e", max_size=12), st.randoms())
def test_queries_are_necessary(pieces, noise, rng):
    pattern = "".join(pieces)
    query = trigram_query(pattern)
    made = {"[xy]": "xy", "(foo|ba)": ["foo", "ba"], "d?": ["d", ""], "(qrs)+": ["qrs", "qrsqrs"], "[a-z]*": ["", "k", "lm"],
            "\\d": "17", "(?:uv|wxyz)?": ["uv", "wxyz", ""], ".": "~q"}
    for _ in range(5):
        text = "".join(rng.choice(made[p]) if p in made else p for p in pieces)
        assert re.search(pattern, text)
        grams = {text[k : k + 3] for k in range(len(text) - 2)}
        assert not query or any(c <= grams for c in query)


def test_known_queries():
    assert trigram_query("AKIA[A-Z0-9]{16,}") == [frozenset({"aki", "kia"})]
    assert trigram_query("[0-9a-f]{24,}") == [] and trigram_query("abc|x+") == []
    assert trigram_query("x(a+)bcd") == [frozenset({"bcd"})]


def test_only_full_scans_and_empty(docs):
    found = scan(docs([(1, HEX)]), (Rule("hex", "[0-9a-f]{24,}"),)).collect()
    assert [[tuple(s) for s in r.spans] for r in found] == [[(0, 0, 48, "hex")]]
    assert scan(docs([])).count() == 0


def test_no_python_and_no_shuffle_in_the_plan(docs):
    plan = scan(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.count("(?=(") == 1  # the postings are made once, for all rules


def test_work_grows_with_the_hits(docs):
    def seconds(n):
        rows = docs([(1, "password=abcdef12 x " * n)])
        start = time.perf_counter()
        (found,) = scan(rows).collect()
        took = time.perf_counter() - start
        assert [(s.start, s.end) for s in found.spans] == [(20 * k, 20 * k + 17) for k in range(n)]
        return took

    seconds(1000)
    assert min(seconds(64_000) for _ in range(2)) < 2.5 * max(seconds(32_000) for _ in range(2))


def test_postings(docs):
    texts = ["Password PASSWD", "ss", None, "", "toKen aki akiakia", "-----BEGIN x"]
    trigrams = asked_for(RULES)
    found = {}
    for r in postings(docs([*enumerate(texts)]), trigrams).join(docs([*enumerate(texts)]).select("doc_id", row_key("doc_id", "text").alias("row")), "row").collect():
        assert r.trigram not in found.setdefault(r.doc_id, set())
        found[r.doc_id].add(r.trigram)
    for k, text in enumerate(texts):
        folded = (text or "").lower()
        assert found.get(k, set()) == {g for g in trigrams if g in folded}
