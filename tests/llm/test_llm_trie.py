import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderflow.llm import trie
from orderflow.llm.trie import SpillingQueue, prefix_trie

SHAPE = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).digest()


def brute(rows):
    """Rows of every node from (conv, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in m if end))
        above = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), above, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, n=260):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.choice((0, 1, 3, 8, 9))):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], rnd.choice(["a", "b", "ä" * 7, ""])))
    return rows


EDGES = [(None, 1, "user", "lost"), (5, None, None, None), (5, None, "user", "x"), (5, 3, "user", "x"), (5, 3, "user", "x"), (5, 3, "user", "w"), (900, 0, "", "😀 é"), (907, 0, "user", "t"), (100000000007, 2, None, "z")]


@pytest.mark.parametrize("most,queue", [(65_536, 200_000), (20, 3), (0, 2)])
def test_equals_brute_force(spark, most, queue):
    rows = rows_of(1) + EDGES
    got = prefix_trie(spark.createDataFrame(rows, SHAPE), most, queue).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_long_conversations_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 8)
    rows = [(c, t, "user", str(t // (c + 1))) for c in range(12) for t in range(c * 7 % 50)] + [(3, t, "user", "same") for t in range(40, 90)]
    got = prefix_trie(spark.createDataFrame(rows, SHAPE), 30, 4).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_copies_other_columns_and_empty_tables(spark):
    rows = [(c, t, "user", f"turn {t}", c, "x") for c in range(400) for t in range(4)]
    docs = spark.createDataFrame(rows, SHAPE + ", depth long, key string")
    got = prefix_trie(docs, 50).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([r[:4] for r in rows])
    assert prefix_trie(spark.createDataFrame([], SHAPE)).count() == 0


def test_queue_spills_and_keeps_order():
    rnd = random.Random(4)
    queue = SpillingQueue(most=10, block=3)
    left = defaultdict(list)
    for step in range(300):
        key = step + rnd.randrange(1, 60)
        queue.push(key, step)
        left[key].append(step)
        assert sorted(queue.pop(step)) == sorted(left.pop(step, []))
        assert len(queue.heap) <= 10
    assert queue.file is not None
    assert {k: sorted(queue.pop(k)) for k in sorted(left)} == dict(left)
