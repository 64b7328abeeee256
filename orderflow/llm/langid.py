"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte n-grams (two to four bytes, within
words). Embeddings and softmax are trained by stochastic gradient descent in numpy on
a bounded sample of labelled rows; every text is then scored whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm import textops
from orderflow.llm.tasks import in_arrow

BUCKETS = 1 << 13
_SHIFT = np.uint32(32 - 13)
_ROWS = 128
#: Weight of an even distribution in the share of an n-gram under a label.
_EVEN = 0.05
#: Variance of the mean cost between long texts of one language.
_BETWEEN = 0.05
#: Held-out rows from which on strangeness is judged, and room above the strangest right one.
_JUDGED = 50
_ROOM = 1.5

#: Letters a to z, A-Z as a to z, bytes beyond ASCII as they are, all else a blank.
_LETTER = np.where(((textops.LOWER >= 97) & (textops.LOWER <= 122)) | (np.arange(256) >= 128), textops.LOWER, 32).astype(
    np.uint8
)


def features(text: np.ndarray) -> np.ndarray:
    """Counts of the hashed n-grams of a text's bytes; memory follows a window, not the text."""
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(text), 1 << 20):
        tail = [32] if lo + (1 << 20) >= len(text) else []
        head = [32] if lo == 0 else []
        a = np.concatenate([np.array(head, np.uint8), _LETTER[text[max(0, lo - 3) : lo + (1 << 20)]], np.array(tail, np.uint8)])
        blank = a == 32
        a = a.astype(np.uint32)
        value = a
        for n in (2, 3, 4):
            value = (value[: len(a) - n + 1] << np.uint32(8)) | a[n - 1 :] if len(a) >= n else np.zeros(0, np.uint32)
            if n == 2:
                keep = ~(blank[:-1] & blank[1:])
            elif n == 3:
                keep = ~blank[1:-1]
            else:
                keep = ~(blank[1:-2] | blank[2:-1])
            h = ((value[keep] ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(2654435761)) >> _SHIFT
            counts += np.bincount(h, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # embedding times softmax weight: BUCKETS x labels
    bias: np.ndarray
    temperature: float
    threshold: float
    surprise: np.ndarray  # what an n-gram costs under a label, minus log share: labels x BUCKETS
    limit: float  # the most that a text may cost under its label, in spreads

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        logits = ((counts / total).astype(np.float32) @ self.table + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def strangeness(self, counts: np.ndarray, label: np.ndarray) -> np.ndarray:
        """How far a text's mean cost under its label lies above the label's own, in spreads.

        The spread is that of the n-grams, less the more of them a text has, and a fixed part
        for what texts of one language differ by.
        """
        cost = self.surprise.astype(float)
        share = np.exp(-cost)
        mean = (share * cost).sum(axis=1)
        variance = (share * cost**2).sum(axis=1) - mean**2
        n = np.maximum(counts.sum(axis=1), 1)
        own = np.array([c @ cost[j] for c, j in zip(counts, label, strict=True)]) / n
        return (own - mean[label]) / np.sqrt(variance[label] / n + _BETWEEN)


def fit(counts: np.ndarray, label: np.ndarray, labels: list[str], seed: int, epochs: int, width: int, reject: float, precise: float = 0.99) -> Model:
    """Trains on four fifths of the rows; the rest sets temperature and what is rejected.

    The threshold is the smallest probability from which on `precise` of the held-out rows are
    right, but never one that rejects more than `reject` of the right rows. A softmax is sure of
    languages that it never saw too, so a text is also rejected whose n-grams cost more under
    its label than `_ROOM` times what the strangest right held-out row does; with fewer
    than `_JUDGED` held-out rows nothing is rejected for that.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(label))
    cut = max(1, len(order) * 4 // 5)
    train, test = order[:cut], order[cut:] if cut < len(order) else order
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = (counts / total).astype(np.float32)
    scale = float(np.mean((x[train] ** 2).sum(axis=1))) or 1.0
    embedding = (rng.standard_normal((BUCKETS, width)) * 0.1).astype(np.float32)
    weight = (rng.standard_normal((width, len(labels))) * 0.1).astype(np.float32)
    bias = np.zeros(len(labels), np.float32)
    truth = np.eye(len(labels), dtype=np.float32)[label]
    steps, step = epochs * -(-len(train) // 32), 0
    for _ in range(epochs):
        for lo in range(0, len(train), 32):
            rows = train[lo : lo + 32]
            rate = 0.5 * (1 - step / steps)
            step += 1
            hidden = x[rows] @ embedding
            logits = hidden @ weight + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - truth[rows]) / len(rows)
            back = error @ weight.T
            weight -= rate * (hidden.T @ error + 1e-5 * weight)
            bias -= rate * error.sum(axis=0)
            embedding -= (rate / scale) * (x[rows].T @ back)
        rng.shuffle(train)
    held = np.stack([x[train[label[train] == j]].sum(axis=0, dtype=float) for j in range(len(labels))])
    held /= np.maximum(held.sum(axis=1, keepdims=True), 1e-12)
    surprise = -np.log(held * (1 - _EVEN) + _EVEN / BUCKETS).astype(np.float32)
    model = Model(labels, embedding @ weight, bias, 1.0, 0.0, surprise, float("inf"))

    def loss(temperature: float) -> float:
        model.temperature = temperature
        own = model.probabilities(counts[test])[np.arange(len(test)), label[test]]
        return float(-np.log(np.maximum(own, 1e-12)).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
    p = model.probabilities(counts[test])
    best, top = p.argmax(axis=1), p.max(axis=1)
    right = best == label[test]
    if right.any():
        rising = np.argsort(top, kind="stable")
        kept = np.cumsum(right[rising][::-1])[::-1] / np.arange(len(rising), 0, -1)
        precisely = np.flatnonzero(kept >= precise)
        wanted = top[rising[precisely[0]]] if len(precisely) and precisely[0] else 0.0 if len(precisely) else 1.0
        model.threshold = float(min(wanted, np.quantile(top[right], reject)))
        if len(test) >= _JUDGED:
            strange = model.strangeness(counts[test][right], best[right])
            model.limit = _ROOM * float(max(1.0, strange.max()))
    return model


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        for lo, hi, data, offsets in textops.slices(batch.column(names.index("text"))):
            found = [features(data[offsets[i] : offsets[i + 1]]) for i in range(hi - lo)]
            where = [np.flatnonzero(c) for c in found]
            sizes = np.array([len(w) for w in where])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(names.index(n)).slice(lo, hi - lo) for n in ("lang", "draw")),
                    textops.lists(np.concatenate(where).astype(np.int16), sizes, pa.int16()),
                    textops.lists(
                        np.concatenate([c[w] for c, w in zip(found, where, strict=True)]).astype(np.int32), sizes, pa.int32()
                    ),
                ],
                names=["lang", "draw", "bucket", "times"],
            )


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_rows: int = 2000,
    least_rows: int = 20,
    seed: int = 11,
    epochs: int = 12,
    width: int = 16,
    reject: float = 0.001,
) -> Model | None:
    """A model of every label from about `most_rows` of the labelled rows, about as many of each label; None without any.

    Of each label about `least_rows` are drawn, or all that there are, however many labels that makes.

    Rows without text or label teach nothing. The draw follows a hash of id and text, so
    reruns agree.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").count().collect()  # a row a label
    if not counts:
        return None
    span = 1 << 30
    rows_drawn = max(most_rows, least_rows * len(counts))
    share = [(r["lang"], min(span, span * rows_drawn // (len(counts) * r["count"]))) for r in counts]
    shares = rows.sparkSession.createDataFrame(share, "lang string, below long")
    sample = (
        rows.withColumn("draw", F.xxhash64(F.lit(seed), "id", F.md5("text")))
        .join(F.broadcast(shares), "lang")  # a row a label
        .where(F.pmod("draw", F.lit(span)) < F.col("below"))
        .select("lang", "draw", "text")
    )
    drawn = (
        in_arrow(sample, _counted, "lang string, draw long, bucket array<smallint>, times array<int>")
        .orderBy("draw", "lang")
        .limit(rows_drawn + rows_drawn // 4 + 100)  # far above what the draw gives, so that no label is cut off
        .toArrow()
    )
    if not drawn.num_rows:
        return None
    lang = drawn.column("lang").to_pylist()
    labels = sorted(set(lang))
    x = np.zeros((len(lang), BUCKETS), np.int32)
    for chunk_bucket, chunk_times, lo in _chunks(drawn):
        owner = np.repeat(np.arange(len(chunk_bucket)), np.diff(chunk_bucket.offsets.to_numpy()))
        x[lo + owner, chunk_bucket.flatten().to_numpy()] = chunk_times.flatten().to_numpy()
    return fit(x, np.array([labels.index(v) for v in lang]), labels, seed, epochs, width, reject)


def _chunks(table: pa.Table) -> Iterator[tuple[pa.ListArray, pa.ListArray, int]]:
    lo = 0
    for batch in table.to_batches():
        yield batch.column("bucket"), batch.column("times"), lo
        lo += batch.num_rows


def _predicted(model: Model | None, at: int, drop: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Predicts from the text in column `at`; the last column tells which texts hold a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            known = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best = np.zeros(batch.num_rows, np.int64)
            score = np.zeros(batch.num_rows)
            strange = np.zeros(batch.num_rows)
            if model is None:
                known[:] = False
            for lo, hi, data, offsets in textops.slices(text):
                rows = np.flatnonzero(known[lo:hi])
                for part in np.array_split(rows, max(1, -(-len(rows) // _ROWS))):
                    if len(part):
                        found = np.stack([features(data[offsets[i] : offsets[i + 1]]) for i in part])
                        p = model.probabilities(found)
                        best[lo + part], score[lo + part] = p.argmax(axis=1), p.max(axis=1)
                        strange[lo + part] = model.strangeness(found, best[lo + part])
            lang = [model.labels[b] if k else "und" for b, k in zip(best, known, strict=True)]
            rejected = ~known | (score < (model.threshold if model else 1)) | (strange > (model.limit if model else 0))
            kept = [i for i in range(batch.num_columns - 1) if not (drop and i == at)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in kept),
                    pa.array(lang, pa.string()),
                    pa.array(np.clip(score, 0, 1), pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=[*(batch.schema.names[i] for i in kept), "_lang", "_score", "_rejected"],
            )

    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in `keep` as c0, c1, ..., and `_lang`, `_score`, `_rejected`, for every row of `docs`.

    `_lang` is a learned label, or `und` (score 0, rejected) if the text is null or has no
    letter, or if nothing was learned. `_score` is the calibrated probability of the label;
    below the model's threshold, or with n-grams too strange for the label, the row is rejected.
    Prediction sees the text alone.
    """
    drop = text_col not in keep
    every = [*keep, text_col] if drop else keep
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(every)),
        F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("_known"),
    )
    schema = T.StructType(
        rows.schema.fields[: len(keep)]
        + [T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_rejected", T.BooleanType())]
    )
    return in_arrow(rows, _predicted(model, every.index(text_col), drop), schema)
