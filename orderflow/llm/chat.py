"""Tool calls of conversations: linked to results, put in order, validated, and written as canonical JSON.

Only DataFrame functions run on the data. JSON is read as variant, whose text form has
sorted keys, no blanks and shortest numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.workspace import materialize

# JSON types that a schema may ask for, and what a variant calls them.
TYPES = {
    "string": r"^STRING$",
    "integer": r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)$",
    "boolean": r"^BOOLEAN$",
    "array": r"^ARRAY<.*>$",
    "object": r"^OBJECT<.*>$",
}


def calls_of(messages: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """Calls in messages of the form {"tool_calls": [{"id", "name", "arguments", "after": [ids]}]}; other messages hold none."""
    shape = "tool_calls array<struct<id:string,name:string,arguments:variant,after:array<string>>>"
    found = F.explode(F.from_json(F.col(text_col), shape)["tool_calls"])
    return messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), found.alias("c")).select(
        "conv", "c.id", "turn", "c.name", F.to_json("c.arguments").alias("arguments"), F.coalesce("c.after", F.array().cast("array<string>")).alias("after")
    )


def results_of(messages: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """Results in messages of the form {"call_id", "content"}."""
    read = F.from_json(F.col(text_col), "call_id string, content string")
    return messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), read.alias("r")).where("r.call_id is not null").select(
        "conv", F.col("r.call_id").alias("id"), "turn", F.col("r.content").alias("content")
    )


def levels(calls: DataFrame, waits: DataFrame) -> DataFrame:
    """`conv`, `id`, `level`: the longest chain of calls that a call waits for; none for calls on or behind a cycle.

    `waits` has (`conv`, `id`, `dep`), both ends in `calls`. Each round takes the calls that
    wait for nothing any more, so there are as many rounds as the longest chain has calls.
    """
    pending = waits
    ready = calls.select("conv", "id").join(waits, ["conv", "id"], "left_anti")
    done = None
    level = 0
    while True:
        ready = materialize(ready.withColumn("level", F.lit(level).cast("long")), "chat-level")
        done = ready if done is None else done.union(ready)
        met = ready.select("conv", F.col("id").alias("dep"))
        left = materialize(pending.join(met, ["conv", "dep"], "left_anti"), "chat-waits")
        freed = pending.select("conv", "id").distinct().join(left.select("conv", "id").distinct(), ["conv", "id"], "left_anti")
        if not freed.limit(1).count():
            return done
        pending, ready, level = left, freed, level + 1


def argument_errors(arguments: Column, params: Column) -> Column:
    """What speaks against a JSON object under `params`, an array of (param, type, required), in the order of the names."""
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    fields = F.try_variant_get(value, "$", "map<string,variant>")  # names are data, so none goes into a path

    def one(p: Column) -> Column:
        found = F.try_element_at(fields, p["param"])
        fits = F.lit(False)
        for name, pattern in TYPES.items():
            fits = fits | ((p["type"] == name) & F.schema_of_variant(found).rlike(pattern))
        missing = F.when(p["required"], F.concat(F.lit("missing "), p["param"]))
        return F.when(found.isNull(), missing).when(~fits, F.concat(F.lit("type of "), p["param"]))

    known = F.coalesce(params, F.array().cast("array<struct<param:string,type:string,required:boolean>>"))
    extra = F.filter(F.map_keys(fields), lambda k: ~F.exists(known, lambda p: p["param"] == k))
    every = F.concat(F.filter(F.transform(known, one), lambda e: e.isNotNull()), F.transform(extra, lambda k: F.concat(F.lit("unknown "), k)))
    return F.when(value.isNull() | ~kind.startswith("OBJECT"), F.array(F.lit("not an object"))).when(
        params.isNull(), F.array(F.lit("no such tool"))
    ).otherwise(F.array_sort(every))


def link(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """One row for each call, and for each id that has results only.

    Takes calls (`conv`, `id`, `turn`, `name`, `arguments` as JSON text, `after`: ids), results
    (`conv`, `id`, `turn`, `content`) and tools (`name`, `param`, `type`, `required`; a tool without
    parameters has one row with a null `param`). Returns `conv`, `id`, `turn`, `level`, `name`,
    `n_results`, `errors` and `json`; ordered by conversation, level, turn and id, calls stand
    behind those they wait for.

    Calls and results meet by a hash join on conversation and id. Of several calls or results
    under an id the first by turn counts; more calls are an error. Other errors: a call without
    result or result without call, arguments that don't fit the tool, an `after` that names no
    call of the conversation, and a cycle (level null). Calls without conversation or id
    stand alone, one row each, with that as their error; such results are dropped, as nothing can
    name them. Broken JSON is an error and shows as null. Other columns are ignored; empty tables give an empty one.
    """
    named = calls.select("conv", "id", "turn", "name", "arguments", "after")
    lost = named.where("conv is null or id is null")
    known = materialize(
        named.where("conv is not null and id is not null")
        .groupBy("conv", "id")
        .agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count("*").alias("same"))
        .select("conv", "id", "c.turn", "c.name", "c.arguments", "c.after", "same"),
        "chat-calls",
    )
    asked = known.select("conv", "id", F.explode(F.array_distinct("after")).alias("dep")).where("dep is not null")
    present = known.select("conv", F.col("id").alias("dep"))
    waits = materialize(asked.join(present, ["conv", "dep"], "left_semi"), "chat-waits")
    dangling = asked.join(present, ["conv", "dep"], "left_anti").select("conv", "id").distinct().withColumn("dangling", F.lit(True))
    placed = levels(known, waits)
    answers = (
        results.where("conv is not null and id is not null")
        .groupBy("conv", "id")
        .agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("r"))
        .select("conv", "id", "n_results", F.col("r.content").alias("content"), F.col("r.turn").alias("answered"))
    )
    params = tools.groupBy("name").agg(
        F.array_sort(F.collect_set(F.when(F.col("param").isNotNull(), F.struct("param", F.lower("type").alias("type"), F.coalesce("required", F.lit(False)).alias("required"))))).alias("params")
    )
    linked = (
        known.join(placed, ["conv", "id"], "left")
        .join(dangling, ["conv", "id"], "left")
        .withColumn("is_call", F.lit(True))
        .join(answers, ["conv", "id"], "full")
        .withColumn("fault", F.lit(None).cast("string"))
    )
    alone = lost.select(
        "conv", "id", "turn", "name", "arguments", "after",
        F.lit(1).cast("long").alias("same"), F.lit(0).cast("long").alias("level"), F.lit(None).cast("boolean").alias("dangling"), F.lit(True).alias("is_call"),
        F.lit(None).cast("long").alias("n_results"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("long").alias("answered"), F.lit("no id").alias("fault"),
    )
    every = linked.select(*alone.columns).union(alone).join(params, "name", "left")

    def fault(condition: Column, text: str) -> Column:
        return F.when(condition, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))

    call = F.coalesce("is_call", F.lit(False))
    errors = F.concat(
        fault(F.col("fault").isNotNull(), "no id"),
        fault(~call, "no call"),
        fault(call & F.col("n_results").isNull(), "no result"),
        fault(F.col("same") > 1, "id used again"),
        fault(F.col("dangling"), "waits for no call"),
        fault(call & F.col("level").isNull(), "cycle"),
        F.when(call, argument_errors(F.col("arguments"), F.col("params"))).otherwise(F.array().cast("array<string>")),
    )
    record = F.struct(
        F.try_parse_json("arguments").alias("arguments"),
        F.col("conv").alias("conversation"),
        "id",
        "level",
        "name",
        F.col("content").alias("result"),
    )
    return every.select(
        "conv",
        "id",
        F.coalesce("turn", "answered").alias("turn"),
        "level",
        "name",
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        errors.alias("errors"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("json"),
    )
