"""The temporal URL filter and the exact search against plain versions."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import topk, urlfilter

D0 = date(2024, 1, 1)


def judge(host, day, entries):
    """Verdict by replaying the list day by day."""
    if host is None or day is None:
        return (0, False, None)
    labels = host.split(".")
    above = {".".join(labels[i:]) for i in range(len(labels))}
    active = []
    for name, kind, pattern in {(e[0], e[1], e[2]) for e in entries}:
        if pattern not in above:
            continue
        state, days = False, {}
        for e in entries:
            if e[:3] == (name, kind, pattern):
                days.setdefault(e[4], []).append(e[3])
        for on in sorted(days):
            if on <= day:
                state = "remove" not in days[on]
        if state:
            active.append((-len(pattern), kind == "block", name, pattern))
    first = min(active, default=None)
    return (len(active), bool(first and first[1]), first and first[3])


def test_verdicts_match_a_replay(spark):
    rng = random.Random(6)
    patterns = ["com", "a.com", "x.a.com", "b.org", "y.b.org", "org"]
    entries = [
        (rng.choice("lm"), rng.choice(["block", "block", "allow"]), rng.choice(patterns), rng.choice(["add", "add", "remove"]), D0 + timedelta(days=rng.randrange(40)))
        for _ in range(120)
    ]
    hosts = ["a.com", "x.a.com", "q.x.a.com", "b.org", "y.b.org", "za.com", "org", "c.net"]
    captures = []
    for i in range(400):
        host = rng.choice(hosts)
        url = rng.choice(["http://{}/p?q=http://a.com", "HTTPS://user:pw@{}:8080/#x", "https://{}.", "ftp://{}"]).format(host.upper() if i % 7 == 0 else host)
        captures.append((i, url, host, D0 + timedelta(days=rng.randrange(-3, 45))))
    captures += [(900, None, None, D0), (901, "no scheme a.com", None, D0), (902, "http://a.com", "a.com", None), (903, "", None, D0), (904, "http:///p", None, D0)]
    captures += [captures[0], (None, captures[1][1], captures[1][2], captures[1][3]), (905, "http://a.com/" + "x" * 500_000, "a.com", D0)]
    table = spark.createDataFrame([(i, u, d, "x") for i, u, _, d in captures], "page_id long, url string, seen date, pattern string")
    lists = spark.createDataFrame(
        [(*e, 1) for e in entries] + [(None, "block", None, "add", D0, 1), ("l", "block", "c.net", "add", None, 1), ("l", "block", "c.net", "noted", D0, 1)],
        "list string, kind string, pattern string, action string, on date, host int",
    )
    got = urlfilter.verdicts(table, lists, "page_id", "url", "seen").collect()
    assert sorted(((r.id, r.n_active, r.blocked, r.pattern) for r in got), key=str) == sorted(
        ((i, *judge(h, d, entries)) for i, _, h, d in captures), key=str
    )


def test_no_entries_no_captures_no_python(spark):
    table = spark.createDataFrame([(1, "http://a.com", D0)], "id long, url string, day date")
    lists = spark.createDataFrame([], "list string, kind string, pattern string, action string, on date")
    found = urlfilter.verdicts(table, lists, "id", "url", "day")
    assert [(r.id, r.n_active, r.blocked) for r in found.collect()] == [(1, 0, False)]
    assert urlfilter.verdicts(table.limit(0), lists, "id", "url", "day").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def brute(rows, k, every):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault((i, tuple(int(np.floor(256 * float(x))) for x in v)), None)
    sizes = [len(v) for _, v in whole]
    most = min(set(sizes), key=lambda s: (-sizes.count(s), s)) if sizes else 0
    rows = [(i, v) for i, v in whole if len(v) == most]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        found = {(sum(a * b for a, b in zip(v, w, strict=True)), i) for p, v in rows if p == q for i, w in rows if i != q}
        best = sorted(found, key=lambda s: (-s[0], s[1]))[:k]
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return out


def run(spark, rows, k, every, **more):
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, score int, v double")
    found = topk.search(table, F.col("id") % every == 0, k=k, **more).collect()
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in found)


@pytest.mark.parametrize("block", [512, 7])
def test_search_matches_all_products(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "TOGETHER", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 6))
    rows = [(i, [float(np.float32(x)) for x in (centres[i % 5] + 0.2 * rng.normal(size=6)) * (1 + 3 * (i % 37 == 0))]) for i in range(300)]
    rows += [(i, rows[4][1]) for i in range(400, 480)]
    rows += [(500, None), (501, []), (502, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (503, [float("nan")] * 6), (504, [float("inf")] * 6), (505, [1.0, 2.0]), (None, rows[3][1])]
    rows += [rows[0], (10, rows[11][1]), (600, [0.0] * 6)]
    assert run(spark, rows, 5, 10, pivots=8) == brute(rows, 5, 10)


def test_few_and_no_vectors(spark):
    assert run(spark, [], 5, 10) == []
    assert run(spark, [(0, None)], 5, 10) == []
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (3, [0.5, 0.5])]
    assert run(spark, rows, 5, 10) == brute(rows, 5, 10)
    assert run(spark, rows[1:], 5, 10) == []
    assert run(spark, [(0, [2.0**40, 1.0]), (1, [3.0, 2.0**30])], 5, 10) == brute([(0, [2.0**40, 1.0]), (1, [3.0, 2.0**30])], 5, 10)
