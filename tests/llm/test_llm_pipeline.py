"""The stages on odd rows, and the queries against their SQL."""

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from tools.compare import connect, rows_of

import __spark_entry__ as contract
from orderflow.llm.membership import without
from orderflow.llm.oracles import ORACLES

BODY = " ".join(f"the word{i} and thing{i % 7} of stone" for i in range(40))
OTHER = " ".join(f"le mot{i} est une chose{i % 5}" for i in range(40))
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, f"{BODY} ending number {i} " + " ".join(f"own{i}x{j}" for j in range(90)), "en", "s1") for i in range(20)]
    rows += [(100 + i, f"{OTHER} fin numero {i} " + " ".join(f"propre{i}x{j}" for j in range(150)), "fr", "s2") for i in range(20)]
    rows += [(200, BODY, "en", "s1"), (201, BODY + " tail", "en", None), (202, BODY, "en", "s1"), (202, BODY, "en", "s1")]
    rows += [(300, None, "en", "s1"), (301, "", "fr", "s1"), (302, " .. 12", "en", "s1"), (None, OTHER + " sans nom", "fr", "s2")]
    rows += [(400, "the word1 and thing2 of stone " + ITEM, "en", "s1"), (401, "the stone " * 60_000, "en", "s1")]
    schema = "doc_id long, text string, lang string, source string, key string, root long, row int, `odd.name` string, slot int, copies int"
    spark.createDataFrame([(*r, "k", 1, 2, "o", 3, 4) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_every_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert docs.columns == (columns if name != "shard" else [c for c in columns if c != "slot"] + ["slot", "shard"])
    assert not set(seen["language"]) & {300, 301, 302} and seen["language"][202] == 2
    kept = seen["near_duplicates"]
    assert kept[200] == 1 and not kept[201] and not kept[202] and kept[0] == 1 and kept[None] == 1
    assert not seen["decontaminate"][400] and seen["decontaminate"][0] == 1
    assert set(seen["mix"]) <= set(seen["decontaminate"]) and max(seen["mix"].values()) <= 2
    assert seen["shard"] == seen["mix"]


def test_few_texts_are_shuffled_to_leave_some_out(spark):
    rows = [(i % 700, f"text {i % 900}") for i in range(2000)] + [(None, "text 1"), (None, None), (3, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lost = [(1, "text 1"), (2, "text 702"), (None, "text 1"), (3, None), (9, "text 8"), (1, "text 1")]
    out = spark.createDataFrame(lost, "id long, gone string")
    match = docs["doc_id"].eqNullSafe(out["id"]) & docs["text"].eqNullSafe(out["gone"])
    keys = F.xxhash64(docs["doc_id"], docs["text"]), F.xxhash64("id", "gone")
    for bits in (6, 10, 24):  # almost all rows, or few, meet the join
        got = without(docs, out, match, *keys, bits=bits)
        assert Counter(tuple(r) for r in got.collect()) == Counter(r for r in rows if r not in lost)
    assert without(docs, out.limit(0), match, *keys).count() == len(rows)


def test_only_suspects_of_a_stage_are_shuffled(spark, folder, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "without", lambda *a, **k: calls.append(a[1].count()) or without(*a, **k))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontaminate):
        docs = stage(spark, docs, folder)
    assert docs.count() and len(calls) == 2 and min(calls) > 0


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_stages_call_distinct_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "shard"]
    assert corpus_pipeline.ORACLE_SQL is None
    names = [n.split("_")[0] for n in contract.queries() if n.startswith("op")]
    assert names == [f"op{i}" for i in range(1, 14)] and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, sf_dir, name):
    found = contract.queries()[name](spark, sf_dir)
    con = connect(sf_dir)
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, theirs.fetchall())
    assert isinstance(con, duckdb.DuckDBPyConnection)


def test_a_short_item_drops_only_what_it_covers(spark, tmp_path):
    spark.createDataFrame([(1, ITEM), (2, "the"), (3, "so it goes")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["the stone and the word", "The", "so it goes.", "so it goes on", f"the {ITEM}", "clean", None, "the " + " ".join(ITEM.split()[:9])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 6, 7]
