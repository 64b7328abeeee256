"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies. Documents stand in
an order that groups like sizes; one random offset a source is added to the running sum
of expected copies, and a document is emitted once for each integer the sum crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.workspace import materialize

#: Rows of a source that share a cell of the running sum, at most about this many for one size class.
CELL_ROWS = 2_000


def word_count(text: Column) -> Column:
    """Runs without blanks and the controls 9 to 13; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hex(column: Column) -> Column:
    return F.conv(F.substring(column, 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, share: float, weights: tuple[int, ...], most: float) -> DataFrame:
    """Adds `target` to (`source`, `source_size`, ...), one row a source.

    Sources stand by code point, null last, and take `weights` in turn. They share
    `share` times all sizes; what is above `most` times a source's size goes to the
    others by weight until none is above. The table has one row a source, so ordering
    it whole is cheap.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(every)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    table = sources.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    until = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        table.withColumn("pool", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("taken_caps", F.coalesce(F.sum("cap").over(until), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(rest))
        .withColumn("level", (F.col("pool") - F.col("taken_caps")) / F.col("left_weight"))
        .withColumn("level", F.max("level").over(whole))
    )
    return levels.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).drop(
        "weight", "cap", "pool", "taken_caps", "left_weight", "level"
    )


def mixture(
    docs: DataFrame,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    weights: tuple[int, ...] = (5, 2, 1),
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """One row per row of `docs`: `row` (struct of the columns in `keep`), `size`, `source_size`, `target`, `copies`, `taken`.

    The order within a source is size class (binary digits), cell, size and a keyed md5 of
    id and text, so reruns agree; rows alike in all of these are interchangeable. A null
    source is a source, null and empty texts have size 0 and may be taken without words, a
    source without words takes nothing. A document has at most `most` copies, rounded up.
    An empty table gives an empty table. `keep` may hold any names.
    """
    text = F.col(text_col)
    tie = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))))
    rows = materialize(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
            F.col(source_col).alias("source"),
            word_count(text).alias("size"),
            tie.alias("tie"),
        ).withColumn("class", F.length(F.bin("size"))),
        "mix-rows",
    )
    sources = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    sources = materialize(
        targets(sources, share, weights, most).select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            F.ceil(F.col("n") / F.lit(CELL_ROWS)).alias("cells"),
            F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)).alias("rate"),
            (_hex(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("source", F.lit(""))))) / F.lit(float(1 << 32))).alias("offset"),
        ),
        "mix-sources",
    )
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "cell", F.pmod(_hex(F.col("tie")), F.col("cells"))
    )
    cells = placed.groupBy("of", "class", "cell").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("of").orderBy("class", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(
        cells.select(
            F.col("of").alias("cell_of"),
            F.col("class").alias("cell_class"),
            F.col("cell").alias("cell_no"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        ),
        "mix-cells",
    )
    inside = Window.partitionBy("of", "class", "cell").orderBy("size", "tie")
    ranked = placed.withColumn("in_cell", F.row_number().over(inside)).join(
        cells,
        F.col("of").eqNullSafe(F.col("cell_of"))
        & (F.col("class") == F.col("cell_class"))
        & (F.col("cell") == F.col("cell_no")),
    )
    upto = F.col("before") + F.col("in_cell")
    crossed = F.floor(F.col("rate") * upto + F.col("offset")) - F.floor(F.col("rate") * (upto - 1) + F.col("offset"))
    return ranked.withColumn("copies", F.least(crossed, F.ceil(F.col("rate")))).select(
        "row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
