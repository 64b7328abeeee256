"""Prefix trie of conversations, with totals of every subtree by time-forward processing.

A node is a distinct sequence of first turns. Its key is a chain of digests: conversations are
hashed turn by turn in segments, segments are chained, and so a node's key fixes its whole path.

Totals go from the leaves to the root. Nodes are sorted by falling depth (an external sort of
Spark's), every node takes what its children have sent from a priority queue that spills, adds
its own, and sends the sum to its parent. That happens in shards first: a shard holds whole
subtrees of a bounded number of turns. What leaves the shards is added up for each parent and
goes through the nodes above, the shard roots' ancestors, in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.tasks import in_arrow
from orderflow.workspace import materialize

#: Turns hashed as one piece, and the range of turn numbers that is counted as one.
SEGMENT = 1024
#: Turns below a node, counted for every conversation through it, up to which its subtree stays in one shard.
SHARD_TURNS = 65_536
#: Messages that a queue keeps in memory.
QUEUE = 200_000
ROOT = b""


class SpillingQueue:
    """A priority queue of (key, value) pairs that writes sorted runs to a file of its own beyond `most` entries.

    The file is private to a task and goes with it, like the files of a sort.
    """

    def __init__(self, most: int = QUEUE, block: int = 1000):
        self.most, self.block = most, block
        self.heap: list = []
        self.heads: list = []
        self.runs: list[Iterator] = []
        self.file = None
        self.n = 0

    def push(self, key, value) -> None:
        heapq.heappush(self.heap, (key, self.n, value))
        self.n += 1
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        entries, places = sorted(self.heap), []
        for i in range(0, len(entries), self.block):
            places.append(self.file.tell())
            pickle.dump(entries[i : i + self.block], self.file, pickle.HIGHEST_PROTOCOL)
        self.heap = []
        self.runs.append(self._read(places))
        self._advance(len(self.runs) - 1)

    def _read(self, places: list[int]) -> Iterator:
        for place in places:
            self.file.seek(place)
            yield from pickle.load(self.file)

    def _advance(self, run: int) -> None:
        if (entry := next(self.runs[run], None)) is not None:
            heapq.heappush(self.heads, (entry, run))

    def pop(self, key) -> Iterator:
        """Values of `key`, which must be the smallest key left."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[2]
        while self.heads and self.heads[0][0][0] == key:
            entry, run = heapq.heappop(self.heads)
            self._advance(run)
            yield entry[2]


def _counted(rows: DataFrame, group: str, bucket: Column, order: list[Column], output: str) -> DataFrame:
    """`rows` with their place in `group`, from 1; buckets follow the order, and only their sizes are summed over a group."""
    cut = rows.withColumn("_bucket", bucket)
    sizes = cut.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_group"), F.col("_bucket").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    joined = cut.join(offsets, (F.col(group) == F.col("_group")) & F.col("_bucket").eqNullSafe(F.col("_at")))
    return joined.withColumn(output, (place + F.col("_before")).cast("long")).drop("_bucket", "_group", "_at", "_before")


def ordered(conversations: DataFrame) -> DataFrame:
    """`conv`, `pos` (from 1), `digest` and `chars` of every turn, in the order of turn (null first), role and digest."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv is not null")
    size = F.length(F.encode(F.col("role"), "UTF-8"))
    hashed = rows.select(
        "conv", "turn", "role",
        F.unhex(F.sha2(F.concat_ws(":", size.cast("string"), "role", "text"), 256)).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return _counted(hashed, "conv", F.floor(F.col("turn") / SEGMENT), order, "pos").select("conv", "pos", "digest", "chars")


def shared_turns(conv: Column) -> Column:
    """Turns that a conversation takes from the first of its hundred."""
    return F.crc32(conv.cast("string")) % 6


def rebuilt(turns: DataFrame) -> DataFrame:
    """`conv`, `depth`, `digest`, `chars`: the first h turns of conversation c - c % 100, then c's own behind its first h."""
    convs = turns.groupBy("conv").agg(F.max("pos").alias("own")).withColumn("h", shared_turns(F.col("conv")))
    heads = turns.where((F.col("conv") % 100 == 0) & (F.col("pos") <= 5)).select(F.col("conv").alias("base"), "pos", "digest", "chars")
    heirs = convs.where("h > 0").select("conv", "h", (F.col("conv") - F.col("conv") % 100).alias("base"))
    taken = heirs.join(heads, "base").where(F.col("pos") <= F.col("h")).select("conv", F.col("pos").alias("depth"), "digest", "chars")
    lengths = heads.groupBy("base").agg(F.max("pos").alias("has"))
    shifts = heirs.join(lengths, "base", "left").select(
        F.col("conv").alias("_conv"), "h", F.least("h", F.coalesce("has", F.lit(0))).alias("got")
    )
    joined = turns.join(shifts, F.col("conv") == F.col("_conv"), "left").where(F.col("pos") > F.coalesce("h", F.lit(0)))
    kept = joined.select("conv", (F.col("pos") - F.coalesce("h", F.lit(0)) + F.coalesce("got", F.lit(0))).alias("depth"), "digest", "chars")
    return taken.unionByName(kept)


def _within(batches):
    """Digest of each turn with those before it in its segment; rows come by conversation, segment and depth."""
    at, state = None, b""
    for batch in batches:
        made, before = [], []
        for key, digest in zip(zip(batch.column("conv").to_pylist(), batch.column("segment").to_pylist(), strict=True), batch.column("digest").to_pylist(), strict=True):
            state = None if key != at else state
            before.append(state)
            state = hashlib.sha256((state or b"") + digest).digest()
            at = key
            made.append(state)
        kept = ("conv", "segment", "depth", "chars")
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(made, pa.binary()), pa.array(before, pa.binary())], [*kept, "within", "above"])


def _key(before: bytes, within: bytes) -> bytes:
    return hashlib.sha256(before + within).digest()[:16]


def _chained(batches):
    """Key of the last node of the segments before each segment; rows come by conversation and segment."""
    at, last = None, ROOT
    for batch in batches:
        made = []
        for conv, within in zip(batch.column("conv").to_pylist(), batch.column("within").to_pylist(), strict=True):
            last = ROOT if conv != at else last
            at = conv
            made.append(last)
            last = _key(last, within)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("segment"), pa.array(made, pa.binary())], ["conv", "segment", "before"])


def paths(rows: DataFrame) -> DataFrame:
    """`conv`, `depth`, `chars`, `key` and `parent` (key of the node above) of every rebuilt turn.

    Only the last digests of segments pass through one task a conversation.
    """
    cut = rows.withColumn("segment", F.floor((F.col("depth") - 1) / SEGMENT))
    spread = cut.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "depth")
    hashed = materialize(in_arrow(spread, _within, "conv long, segment long, depth long, chars long, within binary, above binary"), "trie-turns")
    long = hashed.where(F.col("depth") % SEGMENT == 0).select("conv", "segment", "within")
    tails = long.unionByName(hashed.where(F.col("depth") % SEGMENT == 1).where("segment > 0").select("conv", "segment", F.lit(b"").alias("within")))
    ends = tails.groupBy("conv", "segment").agg(F.max("within").alias("within"))
    chain = in_arrow(ends.repartition("conv").sortWithinPartitions("conv", "segment"), _chained, "conv long, segment long, before binary")
    later = hashed.where("segment > 0").join(chain, ["conv", "segment"])
    every = hashed.where("segment = 0").withColumn("before", F.lit(ROOT)).select(*later.columns).unionByName(later)

    def key(within: Column) -> Column:
        return F.substring(F.unhex(F.sha2(F.concat("before", within), 256)), 1, 16)

    above = F.when(F.col("above").isNull(), F.col("before")).otherwise(key(F.col("above")))
    return every.select("conv", "depth", "chars", key(F.col("within")).alias("key"), above.alias("parent"))


def _digests(batches):
    """SHA-256 of each node's conversation ids; rows come by node and id, so a node of any size is one pass."""
    key, state = None, None
    for batch in batches:
        keys, made = [], []
        for at, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if state is None or at != key:
                if state is not None:
                    keys.append(key)
                    made.append(state.hexdigest())
                key, state = at, hashlib.sha256(str(conv).encode())
            else:
                state.update(b"," + str(conv).encode())
        yield _pairs(keys, made)
    if state is not None:
        yield _pairs([key], [state.hexdigest()])


def _pairs(keys: list, made: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(made, pa.string())], ["key", "ends_sha256"])


_TOTALS = pa.schema([("sent", pa.bool_()), ("key", pa.binary()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])


def _forward(queue: int):
    """Task that passes totals up; rows (`depth`, `key`, `parent`, `top`, own totals) come by falling depth, then key.

    A row with `sent` false holds a node's totals, one with `sent` true what goes to a node elsewhere.
    """

    def run(batches):
        waiting = SpillingQueue(queue)
        for batch in batches:
            out = {name: [] for name in _TOTALS.names}
            columns = (batch.column(c).to_pylist() for c in ("depth", "key", "parent", "top", "leaves", "saved"))
            for depth, key, parent, top, leaves, saved in zip(*columns, strict=True):
                for more in waiting.pop((-depth, key)):
                    leaves, saved = leaves + more[0], saved + more[1]
                rows = [(False, key)]
                if top:
                    rows += [(True, parent)] if depth else []
                else:
                    waiting.push((1 - depth, parent), (leaves, saved))
                for sent, at in rows:
                    out["sent"].append(sent)
                    out["key"].append(at)
                    out["n_leaves"].append(leaves)
                    out["saved_tokens"].append(saved)
            yield pa.RecordBatch.from_pydict(out, schema=_TOTALS)

    return run


def subtree_totals(nodes: DataFrame, below: DataFrame, most: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """`key`, `n_leaves`, `saved_tokens` of every node, summed over its subtree.

    `nodes` has `key`, `depth`, `parent`, `member` (a conversation through it), `leaves` and `saved` (its own),
    and `turns`, the turns at and below it over all conversations. `below` has a (`conv`, `depth`, `key`) row for each node
    of every conversation. Nodes of more than `most` turns stand above the shards; no depth holds more than turns / `most` of them.
    """
    high = materialize(nodes.where(F.col("turns") > most).select("key", "depth", "parent", "leaves", "saved"), "trie-high")
    crossing = below.join(high.select("key"), "key", "left_semi").groupBy("conv").agg(F.max("depth").alias("above"))
    roots = below.join(crossing.withColumnRenamed("conv", "_conv"), F.col("conv") == F.col("_conv"), "left").where(
        F.col("depth") == F.coalesce(F.col("above") + 1, F.lit(0))
    )
    roots = roots.select(F.col("conv").alias("member"), F.col("key").alias("root"))
    low = nodes.where(F.col("turns") <= most).join(roots, "member")
    shards = (
        low.select("depth", "key", "parent", (F.col("key") == F.col("root")).alias("top"), "leaves", "saved", "root")
        .repartition("root")
        .sortWithinPartitions(F.col("depth").desc(), "key")
        .drop("root")
    )
    done = materialize(in_arrow(shards, _forward(queue), "sent boolean, key binary, n_leaves long, saved_tokens long"), "trie-shards")
    arrived = done.where("sent").groupBy(F.col("key").alias("_key")).agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("extra"))
    above = high.join(arrived, F.col("key") == F.col("_key"), "left").select(
        "depth", "key", "parent", (F.col("depth") == 0).alias("top"),
        (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("extra", F.lit(0))).alias("saved"),
    )
    across = in_arrow(above.coalesce(1).sortWithinPartitions(F.col("depth").desc(), "key"), _forward(queue), "sent boolean, key binary, n_leaves long, saved_tokens long")
    return done.where("not sent").unionByName(across.where("not sent")).drop("sent")


def prefix_trie(conversations: DataFrame, most: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """One row for each node: `conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`.

    Takes `conv_id`, `turn`, `role`, `text`. Turns stand by turn (null first), then role and a digest of role and text, so ties are settled and
    repeated rows are turns of their own; null roles and texts are empty, and rows without a conversation are left out. Other columns
    are ignored; an empty table gives no rows. A conversation's turns are ranked and hashed in ranges of 1024. The ids
    that end at one node pass through one task as a stream, since their digest is one.
    """
    turns = materialize(ordered(conversations), "trie-ordered")
    convs = turns.select("conv").distinct()
    steps = materialize(paths(rebuilt(turns)), "trie-paths")
    lengths = convs.join(steps.groupBy("conv").agg(F.max("depth").alias("len")), "conv", "left").select("conv", F.coalesce("len", F.lit(0)).alias("len"))
    starts = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"))
    below = steps.unionByName(starts)
    sized = below.join(lengths, "conv")
    grouped = sized.groupBy("key").agg(
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("conv").alias("member"),
        F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("turns"),
    )
    grouped = materialize(grouped, "trie-grouped")
    children = grouped.where("parent is not null").groupBy(F.col("parent").alias("_key")).agg(F.count("*").alias("n_children"))
    up = grouped.select(F.col("key").alias("_up"), F.col("member").alias("parent_conv_id"))
    nodes = grouped.join(children, F.col("key") == F.col("_key"), "left").drop("_key").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.join(up, F.col("parent") == F.col("_up"), "left").drop("_up"), "trie-nodes")
    own = nodes.select("key", "depth", "parent", "member", "turns", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    totals = subtree_totals(own, below.select("conv", "depth", "key"), most, queue)
    last = sized.where("depth = len").select("key", "conv").repartition("key").sortWithinPartitions("key", "conv")
    ends = in_arrow(last, _digests, "key binary, ends_sha256 string")
    return (
        nodes.join(totals, "key")
        .join(ends, "key", "left")
        .select(
            F.col("member").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
