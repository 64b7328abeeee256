"""Model versions and alias history as append-only tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.gates import enforce
from orderflow.sources.layers import latest_by

CHAMPION = "champion"

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("tags", T.StringType()),
    ]
)

ALIAS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("alias", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("kind", T.StringType()),
    ]
)

ROLLBACK = "rollback"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only registry table; empty while nothing was written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def new_versions(versions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose (name, fingerprint) is not registered yet, with their next version.

    Repeated candidates count once. `candidates` has the columns of
    `versions` without `version`.
    """
    keys = ["name", "fingerprint"]
    unseen = latest_by(candidates, keys, "created_at").join(
        versions.select(*keys), keys, "left_anti"
    )
    last = versions.groupBy("name").agg(F.max("version").alias("_last"))
    order = Window.partitionBy("name").orderBy("created_at", "fingerprint")
    return unseen.join(last, "name", "left").select(
        *[
            (F.coalesce("_last", F.lit(0)) + F.row_number().over(order)).cast("long")
            .alias("version")
            if c == "version"
            else F.col(c)
            for c in versions.columns
        ]
    )


def resolve_versions(versions: DataFrame, candidates: DataFrame) -> DataFrame:
    """(name, fingerprint, version, reused_existing) for every distinct candidate."""
    keys = ["name", "fingerprint"]
    known = candidates.select(*keys).distinct().join(
        versions.groupBy(*keys).agg(F.min("version").alias("version")), keys
    )
    added = new_versions(versions, candidates).select(*keys, "version")
    return known.withColumn("reused_existing", F.lit(True)).unionByName(
        added.withColumn("reused_existing", F.lit(False))
    )


def config_hash(params: Mapping[str, object]) -> str:
    """Hash of the parameters of a run, whatever their order."""
    return hashlib.md5(json.dumps(dict(params), sort_keys=True).encode()).hexdigest()


def code_hash() -> str:
    """Hash of the names and texts of the library's modules."""
    root = Path(__file__).resolve().parent.parent
    digest = hashlib.sha256()
    for path in sorted(root.rglob("*.py")):
        digest.update(str(path.relative_to(root)).encode() + b"\0" + path.read_bytes() + b"\0")
    return digest.hexdigest()


def register_version(spark: SparkSession, path: str, name: str, fingerprint: str,
                     model_path: str, created_at: datetime, tags: Mapping[str, str] | None = None
                     ) -> tuple[int, bool]:
    """Add one version unless its fingerprint is known: (version, reused_existing).

    `tags` holds what is needed to reproduce the model: window bounds, hashes
    of code and configuration.
    """
    versions = read_table(spark, path, VERSION_SCHEMA)
    text = json.dumps(dict(tags or {}), sort_keys=True)
    candidate = spark.createDataFrame(
        [(name, None, fingerprint, model_path, created_at, text)], VERSION_SCHEMA
    )
    outcome = resolve_versions(versions, candidate.drop("version")).first()
    if not outcome["reused_existing"]:
        (
            candidate.withColumn("version", F.lit(outcome["version"]).cast("long"))
            .coalesce(1)
            .write.mode("append")
            .parquet(path)
        )
    return outcome["version"], outcome["reused_existing"]


def set_alias(spark: SparkSession, path: str, name: str, alias: str, version: int,
              at: datetime, kind: str = "set") -> None:
    """Point an alias at a version from `at` on; `kind` tells a rollback from other switches."""
    row = spark.createDataFrame([(name, alias, version, at, kind)], ALIAS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def promote(spark: SparkSession, path: str, name: str, version: int, at: datetime,
            gate_results: DataFrame | None = None) -> None:
    """Make a version the champion; with gate results only when no blocking check failed."""
    if gate_results is not None:
        enforce(gate_results)
    set_alias(spark, path, name, CHAMPION, version, at)


def rollback(spark: SparkSession, path: str, name: str, at: datetime) -> int:
    """Point the champion back at the version that was promoted before the current one.

    Nothing is refitted. A version once withdrawn stays withdrawn: the next rollback
    goes one promotion further back.
    """
    history = read_table(spark, path, ALIAS_SCHEMA).where(
        (F.col("name") == name) & (F.col("alias") == CHAMPION)
    )
    stack = promotions(history, at).first()
    if stack is None or len(stack["versions"]) < 2:
        raise LookupError(f"{name!r} had no other champion before")
    version = stack["versions"][-2]
    set_alias(spark, path, name, CHAMPION, version, at, ROLLBACK)
    return version


def promotions(history: DataFrame, at: datetime) -> DataFrame:
    """(name, alias, versions): the promotions in force at `at`, the last one current.

    A switch adds its version unless it is the current one, a rollback takes the
    last one off. An alias has as many switches as there were decisions.
    """
    steps = (
        history.where(F.col("valid_from") <= F.lit(at))
        .groupBy("name", "alias")
        .agg(F.array_sort(F.collect_list(F.struct("valid_from", "version", "kind"))).alias("steps"))
    )

    def follow(stack, step):
        back = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))
        same = F.coalesce(F.try_element_at(stack, F.lit(-1)) == step["version"], F.lit(False))
        more = F.when(same, stack).otherwise(F.concat(stack, F.array(step["version"])))
        return F.when(step["kind"] == ROLLBACK, back).otherwise(more)

    nothing = F.array().cast("array<bigint>")
    return steps.select("name", "alias", F.aggregate("steps", nothing, follow).alias("versions"))


def current_alias(history: DataFrame, at: datetime | None = None) -> DataFrame:
    """The version every (name, alias) points at `at`, by default now; later switches wait."""
    until = F.current_timestamp() if at is None else F.lit(at)
    return latest_by(
        history.where(F.col("valid_from") <= until), ["name", "alias"], "valid_from", ["version"]
    )


def model_path_of(versions: DataFrame, history: DataFrame, name: str, alias: str,
                  at: datetime | None = None) -> tuple[int, str]:
    """(version, path) behind an alias; never simply the newest version."""
    pointer = current_alias(
        history.where((F.col("name") == name) & (F.col("alias") == alias)), at
    )
    row = pointer.join(versions, ["name", "version"]).select("version", "model_path").first()
    if row is None:
        raise LookupError(f"no version of {name!r} behind alias {alias!r}")
    return row["version"], row["model_path"]


def alias_as_of(events: DataFrame, history: DataFrame, ts_col: str,
                keys: Sequence[str] = ("name", "alias"), bucket: str = "hour") -> DataFrame:
    """Version behind the alias at the time of each event; NULL before the first one.

    Events and switches lie on one time axis per key, cut into buckets of time, and in a
    bucket the last switch is carried along the sorted rows. What holds at the beginning of
    a bucket comes as one more row from a table of buckets, in which only the last switch of
    each is passed on. So no event and no bucket meets the whole history, and a frequent
    alias is spread over its buckets. Of several switches at one time the largest version holds;
    a switch holds for events of its own time. NULL keys and times have no version.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    same = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    version = history.schema["version"].dataType
    at = F.date_trunc(bucket, F.col("_ts"))

    def on_axis(df: DataFrame, ts: str, kind: int, value, row) -> DataFrame:
        return df.select(*same, F.col(ts).cast("timestamp").alias("_ts"), F.lit(kind).alias("_kind"), value.alias("_version"), row.alias("_row"))

    shape = events.select(F.struct(*events.columns).alias("r")).schema["r"].dataType
    nothing = F.lit(None).cast(shape)
    rows = on_axis(events, ts_col, 1, F.lit(None).cast(version), F.struct(*events.columns)).withColumn("_at", at)
    known = history.where(F.col("valid_from").isNotNull())
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    switches = on_axis(known, "valid_from", 0, F.col("version"), nothing).withColumn("_at", at)

    last = switches.groupBy(*names, "_at").agg(F.max(F.struct("_ts", "_version"))["_version"].alias("_last"))
    used = rows.select(*names, "_at").distinct().withColumn("_last", F.lit(None).cast(version))
    buckets = last.unionByName(used).groupBy(*names, "_at").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(
        *names, F.lit(None).cast("timestamp").alias("_ts"), F.lit(0).alias("_kind"),
        F.last("_last", ignorenulls=True).over(before).alias("_version"), nothing.alias("_row"), "_at",
    )
    order = (
        Window.partitionBy(*names, "_at")
        .orderBy(F.col("_ts").asc_nulls_first(), "_kind", "_version")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = rows.unionByName(switches).unionByName(carried)
    found = merged.withColumn("_version", F.last("_version", ignorenulls=True).over(order))
    found = found.where("_kind = 1").withColumn("_version", F.when(F.col("_ts").isNotNull(), F.col("_version")))
    return found.select("_row.*", F.col("_version").alias("version"))
