"""Driver queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import chat, langid, secrets, spelling, syncmers, toxicity, urlfilter
from orderflow.llm.decontaminate import contamination
from orderflow.llm.jaccard import JaccardJoin
from orderflow.llm.mixing import mixture, word_count
from orderflow.llm.sharding import shard
from orderflow.llm.topk import search
from orderflow.llm.trie import prefix_trie

SHARDS = [f"shard-{i:03d}" for i in range(32)]
SLOTS = 4099


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(column: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(folds))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text, by pattern and by assignment."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))

    def text(only: Column) -> Column:
        parts = F.transform(only, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def many(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        many("assign").alias("n_assign"),
        many("access").alias("n_access"),
        many("hex").alias("n_hex"),
        F.sha2(text(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op2_chat_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results that Spark derives from the turns of all conversations.

    A user's turn is a call, the assistant's turn behind it the result. A call waits for the
    one in the middle of the turns before it. The tool follows the number of words.
    """
    turns = _table(spark, sf_dir, "conversations")
    words = word_count(F.col("text"))
    side = F.col("turn") % 2
    middle = side + 2 * F.floor((F.col("turn") - side) / 4)
    tool = F.when(words <= 25, F.lit("search")).otherwise(F.lit("summarise"))
    arguments = F.to_json(
        F.struct(
            words.alias("words"),
            F.col("text").alias("query"),
            F.when(words % 2 == 0, F.col("turn")).alias("limit"),
        )
    )
    calls = turns.where("role = 'user'").select(
        F.col("conv_id").alias("conv"),
        F.concat(F.lit("call_"), F.col("turn")).alias("id"),
        "turn",
        tool.alias("name"),
        arguments.alias("arguments"),
        F.when(middle < F.col("turn"), F.array(F.concat(F.lit("call_"), middle.cast("string"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"),
        F.concat(F.lit("call_"), F.col("turn") - 1).alias("id"),
        "turn",
        F.col("text").alias("content"),
    )
    tools = spark.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(n).alias("name"), F.lit(p).alias("param"), F.lit(t).alias("type"), F.lit(r).alias("required"))
                    for n, p, t, r in (
                        ("search", "query", "string", True),
                        ("search", "words", "integer", True),
                        ("summarise", "query", "string", True),
                        ("summarise", "words", "integer", True),
                        ("summarise", "limit", "integer", True),
                    )
                )
            )
        )
    )
    return chat.link(calls, results, tools).select(
        F.col("conv").alias("conv_id"),
        F.col("id").alias("call_id"),
        "turn",
        "level",
        "name",
        "n_results",
        F.array_join("errors", "; ").alias("errors"),
        "json",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside ten-word windows of benchmark items."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of 90 % and more between the 3-word shingle sets of all documents."""
    joined = JaccardJoin(_table(spark, sf_dir, "documents"), k=3, percent=90)
    return joined.per_document().select(
        F.col("id").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        "component_id",
        F.col("links").alias("n_links"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(_fold("doc_id", 4) != 2))
    return langid.predict(docs, model, ["doc_id"]).select(
        F.col("c0").alias("doc_id"),
        F.coalesce(_fold("c0", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    return mixture(_table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, SHARDS, SLOTS).select("doc_id", "slot", "shard")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from the nearest labelled ones."""
    labels = _table(spark, sf_dir, "labels").where(_fold("doc_id", 5) != 0)
    model, vectors = toxicity.train(_table(spark, sf_dir, "documents"), labels)
    return toxicity.score(vectors, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(_fold("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("evidence", lambda e: e["example"]), ",").alias("evidence"),
    )


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list from the hosts of the pages: some hosts, and domains above some, come, go and come again."""
    host = pages.select(urlfilter.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    digest = F.md5("host")

    def number(at: int) -> Column:
        return F.conv(F.substring(digest, at, 4), 16, 10).cast("int")

    pick = number(1) % 10
    pattern = F.when(number(5) % 3 == 0, F.regexp_replace("host", r"^[^.]+\.(?=[^.]+\.[^.]+\.)", "")).otherwise(F.col("host"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), number(9) % 300)
    rows = host.where(pick < 5).select(
        F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), number(13) % 3 + 1).alias("list"),
        F.when(number(17) % 5 == 0, F.lit("allow")).otherwise(F.lit("block")).alias("kind"),
        pattern.alias("pattern"),
        start.alias("start"),
        (number(21) % 90).alias("days"),
    )
    steps = F.array(
        F.struct(F.lit("add").alias("action"), F.col("start").alias("on")),
        F.struct(F.lit("remove").alias("action"), F.date_add("start", F.col("days")).alias("on")),
        F.struct(F.lit("add").alias("action"), F.date_add("start", F.col("days") + 30).alias("on")),
    )
    return rows.select("list", "kind", "pattern", F.inline(steps))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by a dated list as of its fetch; both dates and list are derived from the pages."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 6), 16, 10).cast("int") % 366
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), day))
    return urlfilter.verdicts(captures, derived_entries(pages), "page_id", "url", "fetched").select(
        F.col("id").alias("page_id"),
        "host",
        F.date_format("fetched", "yyyy-MM-dd").alias("fetched"),
        "n_active",
        "blocked",
        "list",
        "pattern",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    found = search(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they are."""
    return syncmers.fingerprints(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with totals of what lies below."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent word that each is probably a variant of."""
    found = spelling.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_chat_calls": op2_chat_calls,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_mixture": op6_mixture,
    "op7_shards": op7_shards,
    "op8_toxicity": op8_toxicity,
    "op9_url_filter": op9_url_filter,
    "op10_topk": op10_topk,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}
