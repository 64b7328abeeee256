"""The Jaccard join against all pairs."""

import random

import helpers
import numpy as np
import pytest

from orderflow.llm import jaccard
from orderflow.llm.components import components
from orderflow.llm.jaccard import JaccardJoin, size_bands


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for size in (2, 5, 9, 12, 20, 40, 80, 200) * 5:
        base = [rng.choice(vocabulary) for _ in range(size)]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 1, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
                at = rng.randrange(len(words))
                kind = rng.random()
                if kind < 0.4:
                    words[at] = rng.choice(vocabulary)
                elif kind < 0.7 and len(words) > 1:
                    del words[at]
                else:
                    words.insert(at, rng.choice(vocabulary))
            text = " ".join(words)
            rows.append((len(rows), text.upper() if rng.random() < 0.2 else text))
    return rows


def run(spark, rows, k, percent, schema="doc_id long, text string"):
    joined = JaccardJoin(spark.createDataFrame(rows, schema), k=k, percent=percent)
    return joined, [(r.id, r["size"], r.links, r.component_id) for r in joined.per_document().collect()]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_matches_all_pairs(spark, k, percent):
    rows = corpus() + [(9001, None), (9002, ""), (9003, " \n"), (9001, None), (0, "w1 w2"), (None, "w1 w2"), (None, "only here")]
    joined, got = run(spark, rows, k, percent)
    assert sorted(got, key=key) == sorted(helpers.jaccard(rows, k, percent), key=key)
    classes = {}
    for r in joined.members.collect():
        classes[r.cls] = r.key
    pairs = {tuple(sorted((r.a, r.b))) for r in joined.pairs().collect()}
    sets = {}
    for _, text in rows:
        sets.setdefault(helpers.shingles(text, k), text)
    different = list(sets)
    expected = 0
    for i, a in enumerate(different):
        for b in different[:i]:
            common = len(a & b)
            expected += bool(common) and 100 * common >= percent * (len(a) + len(b) - common)
    assert len(pairs) == expected


def test_groups_too_large_for_a_task_are_cut(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 150)
    monkeypatch.setattr(jaccard, "GROUP_MEMBERS", 3)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    rows = corpus(3)[:60]
    for i in range(40):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(60)] = f"x{rng.randrange(50)}"
        rows.append((1000 + i, " ".join(words)))
    _, got = run(spark, rows, 3, 80)
    assert sorted(got) == sorted(helpers.jaccard(rows, 3, 80))


def test_common_shingles_are_found_and_cost_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "WINDOW_SHINGLES", 500)
    monkeypatch.setattr(jaccard, "LEAST_COMMON", 4)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(25))
    rows = []
    for i in range(60):
        own = [f"d{i}x{j}" for j in range(rng.choice([10, 30, 90, 200]))]
        for copy in range(rng.choice([1, 1, 2, 3])):
            words = list(own)
            if copy:
                words[rng.randrange(len(words))] = f"c{i}y{copy}"
            rows.append((len(rows), " ".join(words) + " " + passage))
    joined, got = run(spark, rows, 3, 80)
    assert sorted(got) == sorted(helpers.jaccard(rows, 3, 80))
    assert joined.members.selectExpr("inline(common)").count() > 0


def _tokens_of(sets, percent, common):
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    value = np.array([v for x in sets for v in sorted(x)], np.uint64)
    owner, token = jaccard.coarse_tokens(doc, value, len(sets), percent, np.array(sorted(common), np.uint64))
    return [set(token[owner == i].tolist()) for i in range(len(sets))]


@pytest.mark.parametrize("percent", [80, 90])
def test_strangers_of_mostly_common_shingles_share_no_token(percent):
    rng = np.random.default_rng(4)
    pool = rng.integers(1, 1 << 60, 5000).tolist()
    sets = [set(rng.choice(pool, 50, replace=False).tolist()) | set(rng.integers(1 << 61, 1 << 62, 5).tolist()) for _ in range(60)]
    held = _tokens_of(sets, percent, pool)
    assert sum(bool(a & b) for i, a in enumerate(held) for b in held[:i]) <= 10  # before: nearly all, by their empty parts


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_token_whatever_is_common(percent):
    rng = random.Random(percent)
    pool = [rng.getrandbits(60) for _ in range(4000)]
    for share in (0, 0.3, 0.7, 0.95, 1):
        common = set(rng.sample(pool, int(share * len(pool))))
        sets = []
        for size in (3, 8, 15, 40, 150, 400):
            for _ in range(8):
                base = rng.sample(pool, size)
                most = size * (100 - percent) // 100
                sets.append(set(base))
                sets.append(set(base[rng.randrange(most + 1) :]))
                sets.append(set(base) | {rng.choice(pool) for _ in range(rng.randrange(most + 1))})
        held = _tokens_of(sets, percent, common)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a != b and 100 * len(a & b) >= percent * len(a | b):
                    assert held[i] & held[j]


def test_a_large_group_is_joined_by_class_not_by_token(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 400)
    written, real = {}, jaccard.materialize

    def materialize(df, label, *rest):
        written[label] = real(df, label, *rest)
        return written[label]

    monkeypatch.setattr(jaccard, "materialize", materialize)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(40)]
    _, got = run(spark, rows, 3, 80)
    assert sorted(got) == sorted(helpers.jaccard(rows, 3, 80))
    assert written["jaccard-part-sets"].count() > 1
    assert all(df.count() <= len(rows) for label, df in written.items() if label not in ("jaccard-matrix", "jaccard-held", "jaccard-links"))


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(7, "a b c", 1, "x"), (8, "a b c", 2, "y")], "size long, body string, cls int, tokens string")
    got = JaccardJoin(docs, id_col="size", text_col="body", k=3, percent=90).per_document().collect()
    assert sorted((r.id, r.component_id, r.links) for r in got) == [(7, 7, 1), (8, 7, 1)]
    empty = JaccardJoin(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.per_document().count() == 0
    assert empty.pairs().count() == 0


def test_bands_keep_partners_next_to_each_other():
    for percent in (50, 80, 90, 100):
        first = size_bands(percent)
        band = lambda n: int((first <= n).sum())  # noqa: B023, E731
        for size in range(1, 400):
            most = size * 100 // percent
            assert band(most) - band(size) <= 1


def test_equal_sets_only(spark):
    rows = [(1, "a b c d"), (2, "a b c d e"), (3, "A  b c d"), (4, None), (5, ""), (6, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in JaccardJoin(docs, k=3, percent=100).per_document().select("id", "size", "links", "component_id").collect()]
    assert sorted(got) == sorted(helpers.jaccard(rows, 3, 100))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 500: 500}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_a_window_is_counted_in_ranges_with_the_memory_of_one():
    import tracemalloc

    rng = np.random.default_rng(3)
    window = []
    for _ in range(5):
        value = rng.integers(0, 2**64, 100_000, dtype=np.uint64)
        value[:30_000] = np.uint64(0x9E3779B97F4A7C15) * rng.integers(0, 5_000, 30_000).astype(np.uint64)
        window.append((value, rng.integers(1, 90, 100_000).astype(np.int32)))
    whole = jaccard._common_of(*(np.concatenate(x) for x in zip(*window, strict=True)))
    tracemalloc.start()
    shingle, held = jaccard._common_of_window(window)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(shingle) > 4_000 and (shingle == whole[0]).all() and (held == whole[1]).all()
    assert peak < sum(v.nbytes + s.nbytes for v, s in window) / 2
    assert [len(x) for x in jaccard._common_of_window([(np.zeros(0, np.uint64), np.zeros(0, np.int32))])] == [0, 0]


def test_a_worker_gives_back_what_a_task_has_freed(monkeypatch):
    from orderflow.llm import tasks

    given = []
    monkeypatch.setattr(tasks.ctypes, "CDLL", lambda name: type("C", (), {"malloc_trim": staticmethod(given.append)}))
    assert list(tasks.tidy(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert given == [0]
