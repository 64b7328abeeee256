"""URL filter: dated list entries become validity intervals, joined as of the fetch.

A verdict depends on host and date alone, so captures are first reduced to distinct
pairs of these; a pattern then has at most one row a day on either side of the as-of
join, however many captures a host has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.workspace import materialize


def host_of(url: Column) -> Column:
    """Lower-case host of a URL with a scheme, without user, port and last dot; else null."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """The host and the domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels) - i + 1)))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity of (`list`, `kind`, `pattern`, `action`, `on`): one row `valid_from`, `valid_to` (exclusive, null: open) for each time active.

    `action` is add or remove, in any case; others, and rows without pattern or date, count for nothing.
    Of several actions on a day remove wins. Adding what is active, or removing what isn't, changes nothing.
    """
    action = F.lower("action")
    known = entries.where(action.isin("add", "remove") & F.col("pattern").isNotNull() & F.col("on").isNotNull())
    days = known.groupBy(
        F.coalesce("list", F.lit("")).alias("list"), F.lower("kind").alias("kind"), F.lower("pattern").alias("pattern"), F.to_date("on").alias("on")
    ).agg(F.min(action == "add").alias("active"))
    days = days.where(F.col("kind").isin("block", "allow"))
    order = Window.partitionBy("list", "kind", "pattern").orderBy("on")
    changes = days.withColumn("was", F.coalesce(F.lag("active").over(order), F.lit(False))).where("active <> was")
    return (
        changes.withColumn("valid_to", F.lead("on").over(order))
        .where("active")
        .select("list", "kind", "pattern", F.col("on").alias("valid_from"), "valid_to")
    )


def verdicts(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, date_col: str) -> DataFrame:
    """`id`, `host`, `fetched`, `n_active`, `blocked`, `list`, `pattern`, `valid_from` for every row of `captures`.

    An entry applies to its domain and all hosts below it, on the days of its validity.
    Of the entries that apply the longest pattern decides, allow before block, then the
    list's name, the lowest first; `list`, `pattern` and `valid_from` name it. Captures
    without host, date or entry are not blocked and have `n_active` 0. Equal ids and
    repeated rows each keep their row; other columns are ignored; empty tables are fine.
    """
    rows = captures.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), F.to_date(F.col(date_col)).alias("fetched")
    )
    pairs = rows.where("host is not null and fetched is not null").select("host", "fetched").distinct()
    valid = materialize(intervals(entries), "url-intervals")
    named = valid.select("list", "kind", "pattern").distinct()
    asked = materialize(
        pairs.select("host", "fetched", F.explode(suffixes(F.col("host"))).alias("pattern")).join(
            valid.select("pattern").distinct(), "pattern", "left_semi"
        ),
        "url-asked",
    )
    days = asked.select("pattern", "fetched").distinct().join(named, "pattern")
    line = days.select("list", "kind", "pattern", F.col("fetched").alias("day"), F.lit(1).alias("ask"), F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")).union(
        valid.select("list", "kind", "pattern", F.col("valid_from").alias("day"), F.lit(0).alias("ask"), "valid_from", "valid_to")
    )
    so_far = Window.partitionBy("list", "kind", "pattern").orderBy("day", "ask").rowsBetween(Window.unboundedPreceding, 0)
    span = F.last(F.when(F.col("ask") == 0, F.struct("valid_from", "valid_to")), ignorenulls=True).over(so_far)
    active = (
        line.withColumn("span", span)
        .where("ask = 1 and span is not null and (span.valid_to is null or day < span.valid_to)")
        .select("list", "kind", "pattern", F.col("day").alias("fetched"), F.col("span.valid_from").alias("valid_from"))
    )
    first = F.struct(
        (-F.length("pattern")).alias("long"), (F.col("kind") == "block").alias("late"), "list", "pattern", "valid_from"
    )
    decided = materialize(
        asked.join(active, ["pattern", "fetched"])
        .groupBy("host", "fetched")
        .agg(F.count("*").alias("n_active"), F.min(first).alias("first")),
        "url-verdicts",
    )
    return rows.join(decided, ["host", "fetched"], "left").select(
        "id",
        "host",
        "fetched",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("first.late", F.lit(False)).alias("blocked"),
        F.col("first.list").alias("list"),
        F.col("first.pattern").alias("pattern"),
        F.col("first.valid_from").alias("valid_from"),
    )
