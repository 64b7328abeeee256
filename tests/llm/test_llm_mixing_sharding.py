"""Mixing and sharding."""

from collections import Counter

import pytest

from orderflow.llm import mixing, sharding
from orderflow.llm.mixing import mixture, targets
from orderflow.llm.sharding import lookup_table, shard, write_shards


def water(sizes, weights, share, most):
    """Targets by sharing the excess again until none is above."""
    total = share * sum(sizes)
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        left = total - sum(t for i, t in enumerate(target) if i not in open_)
        over = {i for i in open_ if left * weights[i] / weight >= most * sizes[i]}
        if not over:
            for i in open_:
                target[i] = left * weights[i] / weight
            break
        for i in over:
            target[i] = most * sizes[i]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 10, 1, 50, 0, 7], [1], [0, 0], [5, 5, 5, 5], [1000, 1, 1, 1, 1, 1, 1]])
def test_targets_share_the_excess_again(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")
    got = {r.source: r.target for r in targets(table, 1.5, (5, 2, 1), 2.0).collect()}
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert [got[n] for n in names] == pytest.approx(water(sizes, weights, 1.5, 2.0))


def documents(n=1500):
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 5}"
        rows.append((i, " ".join(["w"] * (i * 7 % 90)), source))
    return rows + [(3, "w w", "s1"), (3, "w w", "s1"), (None, "a b c", "s2"), (None, None, None), (7, "", "empty")]


def test_taken_words_come_near_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 100)
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture(docs, keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "taken", "copies").collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    taken, target = Counter(), {}
    for r in got:
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    for source, aim in target.items():
        assert abs(taken[source] - aim) <= 0.02 * aim + 180
    assert target["empty"] == 0 and abs(sum(taken.values()) - 1.5 * sum(r["size"] for r in got)) < 600
    again = mixture(docs.repartition(7), keep=["doc_id", "source"]).select("row.*", "size", "copies").collect()
    assert Counter((r.doc_id, r.source, r["size"], r.copies) for r in got) == Counter(
        (r.doc_id, r.source, r["size"], r.copies) for r in again
    )


def test_mixture_of_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture(docs, keep=docs.columns).count() == 0
    docs = spark.createDataFrame([(1, "a b", "x", 9, 8, "t")], "doc_id long, text string, source string, size int, copies int, `ti.e` string")
    got = mixture(docs, keep=docs.columns).collect()
    assert [(r.row.asDict(), r["size"]) for r in got] == [(docs.collect()[0].asDict(), 2)]


def test_table_fills_evenly_and_moves_little():
    names = [f"n{i}" for i in range(10)]
    table = lookup_table(names, 1009)
    counts = Counter(table)
    assert set(counts) == set(range(10)) and max(counts.values()) - min(counts.values()) <= 1
    smaller = lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, smaller, strict=True) if a != 9)
    assert moved < 0.15 * 1009
    assert lookup_table(["only"], 2) == [0, 0]
    for shards, slots in ((["a", "a"], 7), ([], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError, match="shards|slots"):
            lookup_table(shards, slots)


def test_rows_go_to_the_shard_of_their_slot(spark, tmp_path):
    names = [f"n{i}" for i in range(4)]
    table = lookup_table(names, 101)
    rows = [(i, f"t{i}", 5, "x") for i in range(200)] + [(3, "other", 5, "x"), (None, "t", 5, "x"), (None, "t", 5, "x"), (None, None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int, _slot string")
    got = shard(docs, names, 101).collect()
    assert len(got) == len(rows)
    assert [c for c in got[0].asDict() if c not in ("slot", "shard")] == ["doc_id", "text", "_slot"]
    slots = {}
    for r in got:
        slot = slots.setdefault((r.doc_id, None if r.doc_id is not None else r.text), r.slot)
        assert r.slot == slot and r.shard == table[r.slot]
    import hashlib

    assert all(r.slot == int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % 101 for r in got if r.doc_id is not None)
    assert shard(docs.limit(0), names, 101).count() == 0
    write_shards(shard(docs, names, 101), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    plan = shard(docs, names, 101)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert sharding.MOST_SLOTS == 1 << 18
