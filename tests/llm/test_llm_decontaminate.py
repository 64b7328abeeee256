"""Winnowing against every window."""

import hashlib
import random

import helpers
import pytest

from orderflow.llm.decontaminate import contamination


def run(spark, rows, items, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs, table, **more).collect()
    return sorted(((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found), key=str)


def expect(rows, items, window=10):
    sha = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    found = helpers.contamination(rows, items, window)
    return sorted(((i, n, hit, len(ids), sha(ids), hit > 0) for i, n, hit, ids in found), key=str)


@pytest.mark.parametrize(("window", "k"), [(10, 5), (10, 10), (4, 1)])
def test_matches_every_window(spark, window, k):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ñ7"]
    sentence = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(sentence(n))) for i, n in enumerate((30, 12, 10, 9, 3, 1, 45, 11))]
    items += [(6, items[6][1]), (20, items[6][1].upper()), (21, None), (22, " ;; "), (None, items[0][1]), (9, "same same same same same same same same same same same")]
    rows = []
    for i in range(40):
        words = sentence(rng.choice([0, 5, 9, 10, 60, 300]))
        for _ in range(rng.choice([0, 1, 2])):
            source = helpers.ALNUM.findall(items[rng.choice([0, 1, 2, 6, 7, 8])][1])
            a = rng.randrange(len(source))
            at = rng.randrange(len(words) + 1)
            words[at:at] = source[a : a + rng.choice([window - 1, window, window + 1, 40])]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(90, None), (91, ""), (92, "same " * 25), (5, rows[5][1]), (None, items[0][1]), (93, "x " * 60_000 + items[0][1])]
    assert run(spark, rows, items, window=window, k=k) == expect(rows, items, window)


def test_empty_tables_and_other_columns(spark):
    rows = [(1, "a b c d e f g h i j k")]
    assert run(spark, rows, []) == expect(rows, [])
    assert run(spark, [], [(1, "a b")]) == []
    docs = spark.createDataFrame([(1, "a b c", 5, "z")], "n_hit long, t string, key int, found string")
    items = spark.createDataFrame([("i", "a b c", 3)], "print string, h1 string, at int")
    got = contamination(docs, items, "n_hit", "t", "print", "h1").collect()
    assert [(r.id, r.n_hit, r.n_items) for r in got] == [(1, 3, 1)]
