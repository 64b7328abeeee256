import hashlib
import random
import re

from pyspark.sql import functions as F

from orderflow.llm import syncmers
from orderflow.llm.syncmers import K, S, fingerprints

md5 = lambda t: hashlib.md5(t.encode()).hexdigest()


UNIT = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1100-\u11ff\u2e80-\ud7ff\uf900-\ufaff\U00020000-\U0003ffff]|[^ \t-\r\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1100-\u11ff\u2e80-\ud7ff\uf900-\ufaff\U00020000-\U0003ffff]{1,16}")


def anchors(text):
    units = UNIT.findall(text)
    inner = [" ".join(units[i : i + S]).encode() for i in range(len(units) - S + 1)]
    out = []
    for i in range(len(units) - K + 1):
        near = inner[i : i + K - S + 1]
        if min(near) in (near[0], near[-1]):
            out.append((i, md5(" ".join(units[i : i + K]))[:6]))
    return out


def tokens(text):
    found = anchors(text)
    if not found:
        return ["00" + md5(text)[:6]] if text else []
    return [f"{min(i - (found[n - 1][0] if n else i), 255):02x}{h}" for n, (i, h) in enumerate(found)]


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    docs = sorted({(k, t or "") for k, t in rows}, key=lambda d: (d[0] is None, -(d[0] or 0), md5(d[1])))
    out = []
    for n, (key, text) in enumerate(docs):
        other = docs[(n + 1) % len(docs)][1]
        edited = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
        own, changed, near = tokens(text), tokens(edited), tokens(other)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(changed), round(alike(own, changed), 9), round(alike(own, near), 9)))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in fingerprints(docs).collect()), key=str)


def texts(seed):
    rnd = random.Random(seed)
    words = ["der", "die", "das", "Haus", "éa", "😀", "\n", "x" * 30, "größer", "."]
    rows = [(rnd.randrange(-40, 200), " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 300)))) for _ in range(60)]
    edges = [(None, "first null"), (None, None), (None, "x" * 700), (5, ""), (5, None), (7, "ab"), (8, "a b c d e f"), (10, "a b c d e"), (11, "你好世界，这是一个测试。" * 9), (12, "ไทย漢字" * 20 + "x" * 40), (9, rows[0][1]), (2**60, "😀" * 50), (2**60 + 1, "\n" * 300)]
    return rows + edges + rows[:5]


def test_equals_brute_force(spark):
    rows = texts(3)
    docs = spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], "doc_id long, text string, n_chars long, found string, cell int")
    assert got(docs) == brute(rows)


def test_anchors_are_context_free_and_never_far_apart(spark):
    rnd = random.Random(1)
    words = ["ab", "c", "déf", "😀", "x" * 40, "字"]
    passage = " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(300))
    rows = [(0, passage), (1, "some other beginning of it " + passage + " and an end"), (2, " ".join(rnd.choice(words) for _ in range(60_000)))]
    docs = spark.createDataFrame(rows, "n long, text string").withColumn("a", syncmers.anchors(F.col("text")))
    found = {r.n: [(a >> 24, a & 0xFFFFFF) for a in r.a] for r in docs.collect()}
    for n, text in rows:
        assert [(i, f"{h:06x}") for i, h in found[n]] == anchors(text)
    moved = [(i + 5, h) for i, h in found[0]]
    assert [x for x in found[1] if moved[0][0] <= x[0] <= moved[-1][0]] == moved
    for places in ([i for i, _ in found[n]] for n in found):
        assert max(b - a for a, b in zip(places, places[1:])) <= K - S + 1


def test_frequent_ids_are_spread_and_order_holds(spark):
    rows = [(0 if n % 3 else n, f"text {n} {n * n} with some more words {n}") for n in range(900)] + [(None, f"null {n}") for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == brute(rows)
    cells = syncmers._ranges(docs.select(F.col("doc_id").alias("id"), F.md5("text").alias("key")), 1100).groupBy("cell", "tie").count()
    assert cells.agg(F.max("count")).first()[0] < 300


def test_lone_and_no_documents_and_only_native_work(spark):
    one = [(3, "only this one text of some words and letters")]
    docs = spark.createDataFrame(one, "doc_id long, text string")
    assert got(docs) == brute(one)
    plan = fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert fingerprints(docs.limit(0)).count() == 0


def test_edits_keep_most_and_strangers_share_little(spark, sf_dir):
    rows = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("n_chars > 500").agg(F.avg("near_edited"), F.min("near_edited"), F.expr("percentile(near_next, 0.5)")).first()
    assert rows[0] > 0.4 and rows[1] > 0.25 and rows[2] < 0.05
