import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import spelling
from orderflow.llm.spelling import Scan, near_words, roots, variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    if len(a) == len(b):
        return a[p + 1 :] == b[p + 1 :]
    a, b = sorted((a, b), key=len)
    return a[p:] == b[p + 1 :]


def brute(rows):
    count = Counter()
    for key, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    out = {}
    for w, n in words.items():
        near = [o for o in words if one_edit(w, o)]
        best = min(near, key=lambda o: (-words[o], o), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = [n, len(near), form, words[form] if form else None, w]
    for w in out:
        while out[out[w][4]][2]:
            out[w][4] = out[out[w][4]][2]
    return {w: tuple(v) for w, v in out.items()}


def texts(seed):
    """Words of a few letters, most of them alike in their first half, with edits and counts far apart."""
    rnd = random.Random(seed)
    stems = ["abcabca", "abcabcb", "zabcabc", "häuserbau", "aaaaaaa", "abababab"]
    rows = []
    for key in range(300):
        words = []
        for _ in range(12):
            w = list(rnd.choice(stems[: rnd.choice((1, 6))]))
            for _ in range(rnd.choice((0, 0, 0, 1, 1, 2))):
                at = rnd.randrange(len(w))
                w[at : at + rnd.choice((0, 1))] = rnd.choice(["", "a", "b", "é", "A"])
            words.append("".join(w))
        rows.append((key, " ".join(words)))
    return rows


@pytest.mark.parametrize("most", [4, 20_000])
def test_equals_brute_force(spark, most):
    rows = texts(5) + [(None, "häuserbau häuserbau"), (7000, None), (7001, ""), (7002, "123 -- abcabca"), (0, texts(5)[0][1])]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n long, word string")
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in variants(docs, most=most).collect()}
    want = brute(rows)
    assert got == want
    assert any(v[2] for v in want.values()) and any(v[4] != w and v[4] != v[2] for w, v in want.items())


def test_hot_head_is_cut_and_words_meet_their_pieces_only(spark):
    rnd = random.Random(2)
    words = sorted({"abc" + "".join(rnd.choice("abcd") for _ in range(rnd.randrange(5, 9))) for _ in range(900)})
    lists = spark.createDataFrame([(False, w, 1) for w in words], "back boolean, key string, n long")
    placed, split = spelling.pieces(lists, 40)
    sizes = Counter(r.piece for r in placed.collect())
    assert max(sizes.values()) <= 40 and sum(sizes.values()) == len(words) and sorted(sizes) == split[False]
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: r.n_near for r in near_words(table, 40).collect()}
    assert got == {w: n for w in words if (n := sum(one_edit(w, o) for o in words))}


def test_scan_jumps_over_ranges():
    words = sorted(["aaaaaaa", *(f"b{i:06d}" for i in range(2000)), "caaaaaa"])
    scan = Scan(words)
    at, place, prefix = scan.near(["aaaaaaa", "zzz"], np.array([0, 0]))
    assert [(i, words[j], p) for i, j, p in zip(at, place, prefix, strict=True)] == [(0, "aaaaaaa", 7), (0, "caaaaaa", 0)]
    assert scan.opened < 60


def test_scan_equals_edit_distance():
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 7))) for _ in range(300)} - {""})
    asked = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 8))) for _ in range(100)]
    scan = Scan(words)
    for exact in (0, 1, 2):
        at, place, _ = scan.near(asked, np.full(len(asked), exact))
        want = {(i, j) for i, a in enumerate(asked) for j, w in enumerate(words) if (a == w or one_edit(a, w)) and a[:exact] == w[:exact] and min(len(a), len(w)) >= exact}
        assert set(zip(at.tolist(), place.tolist(), strict=True)) == want
    at, place, _ = scan.near(asked, np.zeros(len(asked), int), whole=False)
    want = {(i, j) for i, a in enumerate(asked) for j, w in enumerate(words) if any(a[:n] == w or one_edit(a[:n], w) for n in range(len(a) + 1))}
    assert set(zip(at.tolist(), place.tolist(), strict=True)) == want


def test_long_words_chains_and_empty_tables(spark):
    long = "ab" * 40_000
    rows = [(i, " ".join([long] * 2 + [long + "c"] * 30)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r for r in variants(docs).collect()}
    want = brute(rows)
    assert {w: (r.n, r.n_near, r.form, r.form_n, r.root) for w, r in got.items()} == want
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {r.word: r.root for r in roots(chain).collect()} == {f"w{i}": "w11" for i in range(11)}
    assert variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
