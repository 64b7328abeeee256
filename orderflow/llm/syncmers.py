"""Document fingerprints from closed syncmers; DataFrame functions only.

A text is a sequence of units: words, of which long ones are cut, and single characters of scripts
that are written without blanks. A run of K units is an anchor if the smallest of its inner runs of S
units lies at one of its two edges. Whether it is depends on nothing else, so a passage keeps its
anchors wherever it stands, and K - S + 1 runs in a row always hold one.

A fingerprint lists the anchors of the whole text in order, each as a token: the distance to the
anchor before it and a hash. Two fingerprints are as alike as their sets of tokens, so an
anchor counts where its place relative to its neighbour agrees as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.operators.cumulative import bucket_by_edges
from orderflow.workspace import materialize

# Units of an anchor and of its inner runs, hexadecimal digits of a hash and of a distance.
K = 8
S = 1
HASH_DIGITS = 6
GAP_DIGITS = 2
#: Distances from this on are written alike.
_FAR = 16**GAP_DIGITS - 1
# Thai, Lao, Burmese, Khmer, Chinese, Japanese and Korean letters, and the longest unit.
ALONE = "\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u1100-\u11FF\u2E80-\uD7FF\uF900-\uFAFF\U00020000-\U0003FFFF"
LONGEST = 16
UNIT = f"[{ALONE}]|[^ \t\n\x0B\f\r{ALONE}]{{1,{LONGEST}}}"
#: Documents that one sorted range holds, about, and parts that a repeated id is spread over.
RANGE_ROWS = 20_000
TIES = 256
_HASH_BITS = 4 * HASH_DIGITS
_HASH_UNIT = 1 << _HASH_BITS


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _place(anchor: Column) -> Column:
    return F.shiftright(anchor, _HASH_BITS)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def _least_of_next(values: Column, n: int) -> Column:
    """For each place the least of its value and the n - 1 behind it, as far as there are any."""

    def with_place(step: int) -> Callable[[Column], Column]:
        return lambda a: F.zip_with(a, F.slice(a, F.lit(step + 1), F.size(a)), lambda x, y: F.least(x, y))

    span = 1
    while 2 * span <= n:
        values = _let(values, with_place(span))
        span *= 2
    return _let(values, with_place(n - span)) if span < n else values


def anchors(text: Column) -> Column:
    """Array of the anchors in order, each as place * 16^6 + hash, of a text without null; fewer than K units have none."""
    inner_runs = K - S + 1

    def packed(units: Column, i: Column) -> Column:
        digest = F.substring(F.md5(F.array_join(F.slice(units, i + 1, F.lit(K)), " ")), F.lit(1), F.lit(HASH_DIGITS))
        return i.cast("long") * _HASH_UNIT + _number(digest)

    def chosen(units: Column) -> Column:
        runs = units if S == 1 else F.transform(units, lambda _, i: F.array_join(F.slice(units, i + 1, F.lit(S)), " "))

        def at_edges(runs: Column, least: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(units) - K)
            return F.filter(places, lambda i: F.get(least, i) >= F.least(F.get(runs, i), F.get(runs, i + (inner_runs - 1))))

        found = _let(runs, lambda r: _let(_least_of_next(r, inner_runs), lambda least: at_edges(r, least)))
        return F.transform(found, lambda i: packed(units, i))

    found = _let(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda units: F.when(F.size(units) >= K, chosen(units)))
    return F.coalesce(found, F.array().cast("array<bigint>"))


def fingerprint(text: Column) -> Column:
    """The tokens of a text without null."""
    return _let(anchors(text), lambda found: tokens(found, text))


def tokens(found: Column, text: Column) -> Column:
    """Array of numbers distance * 16^6 + hash; a text without anchor has one token of its whole, an empty one none."""
    whole = _number(F.substring(F.md5(text), F.lit(1), F.lit(HASH_DIGITS)))

    def linked(a: Column, b: Column) -> Column:
        gap = F.when(b.isNull(), F.lit(0)).otherwise(F.least(_place(a) - _place(b), F.lit(_FAR)))
        return gap.cast("long") * _HASH_UNIT + a % _HASH_UNIT

    def shifted(list_: Column) -> Column:
        before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice(list_, F.lit(1), F.size(list_) - 1))
        return F.zip_with(list_, before, linked)

    return F.when(F.size(found) > 0, shifted(found)).when(text == "", F.array().cast("array<bigint>")).otherwise(F.array(whole))


def as_text(found: Column) -> Column:
    """A fingerprint as text, eight hexadecimal digits a token."""
    digits = GAP_DIGITS + HASH_DIGITS
    return F.array_join(F.transform(found, lambda t: F.lower(F.lpad(F.hex(t), digits, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared tokens of all tokens of two fingerprints, from 0 to 1; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union).cast("double")


def _ranges(docs: DataFrame, rows: int) -> DataFrame:
    """`docs` with `cell` and `tie`: ranges of falling ids, null last, and within the range of a frequent id parts by text.

    Ids at the edges of ranges are ranges of their own; such a range may be one frequent id, and is cut by `key`.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2 * width, math.ceil(rows / RANGE_ROWS))
    at = docs.select(F.col("id").cast("double").alias("id"))
    edges = sorted(set(at.approxQuantile("id", [i / n for i in range(1, n)], 1.0 / (4 * n))) if rows else [])
    splits = sorted({*edges, *(math.nextafter(e, math.inf) for e in edges)})
    placed = bucket_by_edges(docs.withColumn("_id", F.col("id").cast("double")), "_id", splits, "_cell")
    single = F.col("id").isNull() | ((F.col("_cell") % 2 == 1) & (F.abs("_id") < 2**53) if splits else F.lit(False))
    tie = F.when(single, _number(F.substring("key", 1, 2)) % TIES).otherwise(0)
    cell = F.when(F.col("id").isNull(), 1).otherwise(-F.col("_cell"))
    return placed.withColumns({"cell": cell, "tie": tie.cast("int")}).drop("_id", "_cell")


def with_next(docs: DataFrame, add: Callable[[DataFrame], DataFrame], columns: list[str], rows: int) -> DataFrame:
    """`docs` (`id`, `key`) with what `add` adds and `next`, a struct of `columns` of the document behind it.

    Documents stand by falling id, and the first follows the last. They are sorted in ranges; the last of
    a range gets the first of the next one, so ranges only exchange one row each.
    """
    placed = _ranges(docs, rows)
    order = Window.partitionBy("cell", "tie").orderBy(F.col("id").desc_nulls_last(), "key")
    inner = F.lead(F.struct(*columns)).over(order)
    # Rows meet their neighbours before anything is added, so only texts are shuffled.
    lead = add(placed.repartition("cell", "tie")).withColumn("next", inner).withColumn("_last", F.lead(F.lit(1)).over(order).isNull())

    rank = F.struct((-F.col("id")).alias("i"), F.col("key").alias("k"))
    firsts = materialize(placed.groupBy("cell", "tie").agg(F.min(rank).alias("first")), "syncmers-firsts")
    follow = Window.orderBy("cell", "tie")  # one row a range
    here = F.struct("cell", "tie")
    before = F.coalesce(F.lag(here).over(follow), F.last(here).over(follow.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    chain = firsts.select(before.alias("to"), (-F.col("first.i")).alias("_id"), F.col("first.k").alias("_key"))
    edge = docs.join(chain, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    edge = add(edge).select(F.col("to.cell").alias("_cell"), F.col("to.tie").alias("_tie"), F.struct(*columns).alias("edge"))
    joined = lead.join(edge, F.col("_last") & (F.col("cell") == F.col("_cell")) & (F.col("tie") == F.col("_tie")), "left")
    return joined.withColumn("next", F.when(F.col("_last"), F.col("edge")).otherwise(F.col("next"))).drop("cell", "tie", "_last", "_cell", "_tie", "edge")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next` of every whole text.

    The edited text is the text with its last third (rounded down) replaced by as many first code points of the
    next document by falling id, or all that this has; the first follows the last, and a lone document itself. Null
    ids stand last, ties stand by the text's digest. Rows equal in id and text are one document and give one row.
    A null text is empty. Ids are numbers; other columns are ignored, and an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.md5("text"))
    counted = rows.groupBy("id", "key").agg(F.count("*").alias("n")).agg(F.count("*").alias("all"), F.max("n").alias("most")).first()
    if (counted["most"] or 0) > 1:
        rows = rows.dropDuplicates(["id", "key"])
    paired = with_next(rows, lambda df: df.withColumn("own", fingerprint(F.col("text"))), ["text", "own"], counted["all"])
    chars = F.length("text")
    replaced = F.floor(chars / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), chars - replaced), F.substring(F.col("next.text"), F.lit(1), replaced))
    listed = paired.select("id", chars.cast("long").alias("n_chars"), edited.alias("edited"), "own", F.col("next.own").alias("others"))
    listed = listed.withColumn("changed", fingerprint(F.col("edited")))
    return listed.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("others")).alias("near_next"),
    )
