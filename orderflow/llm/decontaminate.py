"""Benchmark decontamination by winnowing.

Of every run of `window - k + 1` consecutive k-word grams the smallest hash is kept
as a fingerprint, by the same rule in documents and items, so two equal runs of
`window` words always keep an equal fingerprint. Fingerprints are joined, and each
hit is extended to the windows around it, which are compared by 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm import textops
from orderflow.llm.membership import bitmap, may_hold
from orderflow.llm.tasks import in_arrow
from orderflow.workspace import materialize

_FOUND = pa.struct([("print", pa.int64()), ("at", pa.int64()), ("len", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_FOUND_SQL = "array<struct<print:bigint,at:bigint,len:bigint,h1:bigint,h2:bigint>>"


def fingerprints(words: textops.Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window of one text, and the window's fingerprint: its smallest gram, the last of equals."""
    n = len(words.start)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(words.doc[: n - window + 1] == words.doc[window - 1 :])
    grams = np.zeros(n, np.uint64)
    at, value = words.grams(k)
    grams[at] = value
    least = grams[: n - window + 1].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, grams[j : n - window + 1 + j], out=least)
    return starts, least[starts]


def _spans(window: int, k: int, wanted: np.ndarray | None, lengths: tuple[int, ...]) -> Callable:
    """Adds each text's number of words and its windows with their fingerprints.

    Without `wanted` (items): every window, and for a short text its whole sequence.
    With it (documents): the windows whose fingerprint may be an item's, and the runs of
    `lengths` words that may be a short item; a text's windows come once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for lo, hi, data, offsets in textops.slices(batch.column(2)):
                words = textops.Words(data, offsets, textops.ALNUM)
                rows = hi - lo
                starts, prints = fingerprints(words, window, k)
                size = np.full(len(starts), window)
                found = [(starts, prints, size)]
                if wanted is None:
                    for n in range(1, window):
                        first = words.first[:-1][words.count == n]
                        found.append((first, words.hash_at(first, n), np.full(len(first), n)))
                else:
                    fresh = np.zeros(rows, bool)
                    for i, key in enumerate(batch.column(1).slice(lo, rows).to_pylist()):
                        if key is not None and key not in seen:
                            seen.add(key)
                            fresh[i] = True
                    for n in lengths:
                        first, value = words.grams(n)
                        found.append((first, value, np.full(len(first), n)))
                    hit = [may_hold(wanted, p) & fresh[words.doc[s]] for s, p, _ in found]
                    found = [tuple(x[h] for x in f) for f, h in zip(found, hit, strict=True)]
                starts, prints, size = (np.concatenate(x) for x in zip(*found, strict=True))
                h1, h2 = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
                for n in np.unique(size):
                    some = size == n
                    h1[some], h2[some] = words.hash_at(starts[some], int(n)), words.hash_at(starts[some], int(n), 1)
                doc = words.doc[starts]
                order = np.argsort(doc, kind="stable")
                columns = (textops.signed(prints), starts - words.first[doc], size, textops.signed(h1), textops.signed(h2))
                entries = pa.StructArray.from_arrays([pa.array(c[order], pa.int64()) for c in columns], fields=list(_FOUND))
                offs = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(lo, rows) for i in (0, 1)),
                        pa.array(words.count, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offs, pa.int32()), entries),
                    ],
                    names=["id", "key", "n_words", "found"],
                )

    return run


def _spanned(table: DataFrame, id_col: str, text_col: str, run: Callable, label: str) -> DataFrame:
    rows = table.select(F.col(id_col).alias("id"), F.md5(text_col).alias("key"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("key", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("found", T.DataType.fromDDL(_FOUND_SQL)),
        ]
    )
    return materialize(in_arrow(rows, run, schema), label)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """How much of each document lies inside windows of benchmark items.

    Words are runs of digits, letters a to z (A-Z lower-cased) and characters beyond
    ASCII. An item's windows are its runs of `window` words, or the whole of a shorter
    item. Every run of `window` words that a document shares with an item is found.

    One row per row of `docs`: `id`, `key` (md5 of the text, null for null), `n_words`,
    `n_hit` (words inside an occurrence of a window), `n_items`, `items_sha256` (hex
    of the sorted item ids as text, comma-joined), `contaminated` and `longest` (words of
    the longest window that it holds, 0 without any). Null and empty
    texts have no words; items without words have no window; items without an id make
    hits but are not listed; repeated rows each get their own result and repeated items
    count once. Other columns are ignored. Empty tables give an empty or a clean result.

    The bitmap that spares most rows the join has a fixed size; the join alone decides.
    """
    if not 1 <= k <= window:
        raise ValueError("k must lie in 1..window")
    listed = _spanned(items, item_col, item_text_col, _spans(window, k, None, ()), "bench-items").select(
        "id", F.explode("found").alias("f")
    )
    listed = listed.select("id", "f.print", "f.len", "f.h1", "f.h2")
    windows = materialize(listed.select("len", "h1", "h2", "id").distinct(), "bench-windows")
    prints = materialize(listed.select("print").distinct(), "bench-prints")
    short = [r[0] for r in windows.select("len").where(F.col("len") < window).distinct().collect()]  # below `window` values

    members = _spanned(docs, id_col, text_col, _spans(window, k, bitmap(prints, "print"), tuple(sorted(short))), "bench-docs")
    hits = (
        members.select("key", F.explode("found").alias("f"))
        .select("key", "f.print", "f.at", "f.len", "f.h1", "f.h2")
        .join(prints, "print", "left_semi")
        .select("key", "at", "len", "h1", "h2")
        .distinct()
        .join(windows.select("len", "h1", "h2").distinct(), ["len", "h1", "h2"], "left_semi")
    )
    hits = materialize(hits, "bench-hits")
    before = Window.partitionBy("key").orderBy("at", "len").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.withColumn("end", F.col("at") + F.col("len"))
        .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("key")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("at", "reached"))).alias("n_hit"), F.max("len").alias("longest"))
    )
    named = (
        hits.select("key", "len", "h1", "h2")
        .distinct()
        .join(windows, ["len", "h1", "h2"])
        .select("key", F.col("id").cast("string").alias("item"))
        .distinct()
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select(
            "key",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        )
    )
    found = materialize(covered.join(named, "key", "left"), "bench-found")
    return members.select("id", "key", "n_words").join(found, "key", "left").select(
        "id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("longest"),
    )
