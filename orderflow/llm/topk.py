"""Exact top-k search by inner product with a pivot-distance index.

Vectors get one more component, so that all have the length of the longest; then the
highest inner products are the smallest distances. Each vector is keyed by its nearest
pivot and the distance to it, and stands in an annulus of that pivot with bounded
blocks. A query opens the annulus it falls into, and by the k-th best score there all
annuli that the triangle inequality can't rule out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.tasks import in_arrow
from orderflow.workspace import materialize

#: Vectors of a block and queries that open it together, about.
BLOCK = 512
TOGETHER = 1024
_SAFE = 1 << 20  # products of smaller components are summed exactly in doubles


def _whole(column: pa.Array, scale: int) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector, x as double; None for null, empty, or null or non-finite components."""
    out: list[np.ndarray | None] = []
    for row in column:
        if not row.is_valid or row.values.null_count or not len(row.values):
            out.append(None)
            continue
        value = np.floor(row.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        out.append(value.astype(np.int64) if np.isfinite(value).all() and np.abs(value).max() < 2.0**62 else None)
    return out


def _integers(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _whole(batch.column(1), scale)
            keep = [i for i, v in enumerate(rows) if v is not None]
            whole = [rows[i] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array([v.tobytes() for v in whole], pa.binary()),
                    pa.array([len(v) for v in whole], pa.int64()),
                    pa.array([float((v.astype(float) ** 2).sum()) for v in whole], pa.float64()),
                ],
                names=["id", "v", "dim", "norm2"],
            )

    return run


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int64).reshape(len(blobs), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _SAFE and a.shape[1] < 1 << 12:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to `n` rows far from one another: each next is the one farthest from those before."""
    x = sample.astype(float)
    far = ((x - x.mean(axis=0)) ** 2).sum(axis=1)
    chosen = [int(far.argmin())]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray, most: float, query: bool) -> np.ndarray:
    """Distances to the pivots after the added component; a query's is 0."""
    y = x.astype(float)
    lift = np.zeros(len(y)) if query else np.sqrt(np.maximum(0.0, most - (y**2).sum(axis=1)))
    lifted = np.sqrt(np.maximum(0.0, most - (pivots**2).sum(axis=1)))
    square = (y**2).sum(axis=1)[:, None] + lift[:, None] ** 2 + most - 2 * (y @ pivots.T + lift[:, None] * lifted[None, :])
    return np.sqrt(np.maximum(0.0, square))


def _keyed(pivots: np.ndarray, most: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column(0).to_pylist()), pivots, most, False)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near, pa.int64()), pa.array(d[np.arange(len(d)), near], pa.float64())],
                    names=["v", "ids", "pivot", "d"],
                )

    return run


def _measured(pivots: np.ndarray, most: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column(1).to_pylist()), pivots, most, True)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(d), pa.list_(pa.float64()))], names=[*batch.schema.names, "d"]
                )

    return run


def _opened(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scores of each block's queries: the k best of a query with its floor or more, ties to smaller ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for i in range(batch.num_rows):
                queries, members = batch.column(0)[i].values, batch.column(1)[i].values
                q, x = _matrix(queries.field("v").to_pylist()), _matrix(members.field("v").to_pylist())
                ids = members.field("ids")
                owner = np.repeat(np.arange(len(x)), np.diff(ids.offsets.to_numpy()))
                ids = ids.flatten().to_numpy()
                qid = queries.field("qid").to_numpy()
                floor = queries.field("floor").to_numpy()
                score = _products(q, x)[:, owner]
                for r in range(len(q)):
                    keep = np.flatnonzero((score[r] >= floor[r]) & (ids != qid[r]))
                    if len(keep) > k:
                        least = np.partition(score[r][keep], len(keep) - k)[len(keep) - k]
                        keep = keep[score[r][keep] >= least]
                    keep = keep[np.lexsort((ids[keep], -score[r][keep]))][:k]
                    if len(keep):
                        out.append((np.full(len(keep), queries.field("qno")[r].as_py()), np.full(len(keep), qid[r]), ids[keep], score[r][keep]))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["qno", "qid", "id", "score"])

    return run


def _open(chosen: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Opens the (`qno`, `block`, `floor`) in `chosen`; queries of a block go in parts of bounded size."""
    parts = chosen.groupBy("block").agg(F.ceil(F.count("*") / F.lit(TOGETHER)).alias("parts"))
    asked = (
        chosen.join(parts, "block")
        .join(queries.select("qno", "qid", "v"), "qno")
        .groupBy("block", F.expr("pmod(xxhash64(qno), parts)").alias("part"))
        .agg(F.collect_list(F.struct("qno", "qid", "v", "floor")).alias("queries"))
    )
    opened = asked.join(blocks.select("block", "members"), "block").select("queries", "members")
    return in_arrow(opened, _opened(k), "qno long, qid long, id long, score long")


def search(
    table: DataFrame,
    is_query,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    pivots: int = 32,
    sample: int = 4096,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `id`, `score`: the k highest integer inner products of each query.

    Components x become floor(scale * x). `is_query` is a condition on `id`. Candidates
    are all rows but those with the query's id; equal scores go to the smaller id; fewer
    than k candidates give all. Rows without id, and vectors that are null, empty or hold
    a null or non-finite component take no part; nor do vectors of another than the most
    frequent number of components. Rows equal in id and vector count once; an id with
    several vectors has the k best of all. Equal vectors are one entry of the index with their k + 1
    smallest ids, which is all that can ever be returned. No valid vector gives no rows.
    Pivots come from at most `sample` vectors; every vector is indexed and the bounds are exact.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("e")).where("id is not null")
    whole = materialize(
        in_arrow(rows, _integers(scale), "id long, v binary, dim long, norm2 double"), "topk-rows"
    )
    dims = whole.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm2").alias("most")).orderBy(F.desc("n"), "dim").limit(1).collect()  # one row
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    dim, most = dims[0]["dim"], dims[0]["most"]
    valid = whole.where(F.col("dim") == dim)
    entries = materialize(_fewest(valid, k), "topk-entries")
    drawn = entries.orderBy(F.xxhash64("v"), "v").select("v").limit(sample).toArrow()
    points = pick_pivots(_matrix(drawn.column(0).to_pylist()), pivots)

    keyed = materialize(
        in_arrow(entries.select("v", "ids"), _keyed(points, most), "v binary, ids array<long>, pivot long, d double"), "topk-keyed"
    )
    cells = keyed.groupBy("pivot").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n")).select(
        "pivot",
        "low",
        F.ceil(F.col("n") / F.lit(BLOCK)).alias("rings"),
        ((F.col("high") - F.col("low")) / F.ceil(F.col("n") / F.lit(BLOCK))).alias("width"),
    )
    ringed = keyed.join(cells, "pivot").withColumn(
        "ring",
        F.when(F.col("width") > 0, F.least(F.col("rings") - 1, F.floor((F.col("d") - F.col("low")) / F.col("width")))).otherwise(F.lit(0)),
    )
    sizes = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    blocks = materialize(
        ringed.select("pivot", "ring", "d", "v", "ids")
        .join(sizes, ["pivot", "ring"])
        .groupBy("pivot", "ring", F.expr("pmod(xxhash64(v), parts)").alias("part"))
        .agg(F.min("d").alias("low"), F.max("d").alias("high"), F.collect_list(F.struct("v", "ids")).alias("members"))
        .withColumn("block", F.xxhash64("pivot", "ring", "part")),
        "topk-blocks",
    )
    annuli = blocks.select("block", "pivot", "low", "high")

    asked = valid.where(is_query).select(F.col("id").alias("qid"), "v", "norm2").distinct()
    queries = materialize(
        in_arrow(
            asked.withColumn("qno", F.xxhash64("qid", "v")),
            _measured(points, most),
            "qid long, v binary, norm2 double, qno long, d array<double>",
        ),
        "topk-queries",
    )
    spread = queries.select("qno", "norm2", F.posexplode("d").alias("pivot", "d"))
    nearest = queries.select("qno", F.array_position("d", F.array_min("d")).alias("near"))
    own = spread.join(nearest, "qno").where("pivot = near - 1").select("qno", F.col("pivot").cast("long"), "d")
    off = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    start = (
        own.join(annuli, "pivot").groupBy("qno").agg(F.min_by("block", F.struct(off, "block")).alias("block"))
    ).withColumn("floor", F.lit(-(1 << 63)).cast("long"))
    seen = _open(start, queries, blocks, k)
    floors = materialize(
        seen.groupBy("qno").agg(F.count("*").alias("n"), F.min("score").alias("worst")).select(
            "qno", F.when(F.col("n") >= k, F.col("worst")).alias("floor")
        ),
        "topk-floors",
    )
    # |d(q,p) - d(x,p)| <= d(q,x), and d(q,x)^2 = |q|^2 + most - 2 q.x; a little slack covers rounding
    room = F.sqrt(F.greatest(F.lit(0.0), F.col("norm2") + F.lit(float(most)) - 2 * F.col("floor"))) * (1 + 1e-9) + 1e-6 * (1 + float(most) ** 0.5)
    reach = (
        spread.join(floors, "qno", "left")
        .withColumn("room", F.when(F.col("floor").isNull(), F.lit(float("inf"))).otherwise(room))  # greatest() skips nulls
        .select("qno", F.col("pivot").cast("long"), "d", "room", F.coalesce("floor", F.lit(-(1 << 63)).cast("long")).alias("floor"))
    )
    chosen = materialize(
        reach.join(annuli, "pivot")
        .where((F.col("low") <= F.col("d") + F.col("room")) & (F.col("high") >= F.col("d") - F.col("room")))
        .select("qno", "block", "floor"),
        "topk-chosen",
    )
    found = materialize(_open(chosen, queries, blocks, k), "topk-found").select("qid", "id", "score").distinct()
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("qid").alias("query_id"), "rank", "id", "score")


def _fewest(valid: DataFrame, k: int) -> DataFrame:
    """Each vector with its k + 1 smallest ids; tasks thin out before the shuffle."""
    single = valid.select("v", "id").distinct()
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = single.withColumn("n", place).where(F.col("n") <= k + 1)
    return kept.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
