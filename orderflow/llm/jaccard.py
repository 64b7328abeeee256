"""Exact Jaccard join of word-shingle sets through a token-group matrix.

A text's shingles fall into parts by hash; a part's digest is a coarse token. Two sets
at or above the threshold differ in so few shingles that they share a coarse token,
whatever the texts (pigeonhole). Very common shingles are left out of the parts, for what
two sets differ by doesn't grow without them and a digest of a common passage would
hold strangers together. Sets that shared tokens hold together, directly or in
a chain, are similar sets and form a group; a group too large for a task is cut by its
members' smallest tokens. The matrix holds the tokens of the parts of such groups, and
two parts without a common token hold no link. Within a group, and between parts that the
matrix can't rule out, a task takes each set as a query, bounds its overlap by the
token union of the other side, and opens that side only for queries whose bound
reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm import textops
from orderflow.llm.components import components
from orderflow.llm.membership import bitmap, may_hold
from orderflow.llm.tasks import in_arrow
from orderflow.workspace import materialize

#: A shingle is common if this share of all classes has it, and `LEAST_COMMON` at least, of sizes
#: too different for copies of one another. It is counted in windows of so many shingles of a task.
COMMON_SHARE = 0.0002
LEAST_COMMON = 16
WINDOW_SHINGLES = 4_000_000
WINDOW_LEAST = 4
#: A window is counted in so many ranges of shingles, by their first bits.
_RANGE_BITS = 4
#: Common shingles left out at most, the most frequent ones; any choice gives the same links.
MOST_COMMON = 100_000
#: Bytes of the texts whose coarse tokens are worked out at once; tokens take several times that.
TOKEN_BYTES = 1 << 20
#: Shingles and members of a group, about.
GROUP_SHINGLES = 1_000_000
GROUP_MEMBERS = 8192
_STEP = 2_000_000
_U = np.uint64


def size_bands(percent: int) -> np.ndarray:
    """First size of each band; sizes of two sets in a link lie in one band or in two neighbouring ones.

    At 100 linked sets are equal, so one band is enough.
    """
    firsts = [1]
    if percent >= 100:
        return np.array(firsts)
    while firsts[-1] < 1 << 40:
        firsts.append(firsts[-1] * 100 // percent + 1)
    return np.array(firsts)


def differing(size: np.ndarray, most: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles a set of `size` and any set that it links with, of `most` at most, may differ by."""
    return (100 - percent) * (size + np.minimum(size * 100 // percent, most)) // (100 + percent)


def parts_of(first: np.ndarray, band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of parts for sets that meet in a band, and the largest size of a set there.

    Sets of at most `most` shingles differ by at most `differ` of them, so `differ + 1` parts
    always hold an equal one. More parts, after the share of empty ones that the largest
    sets have, let it be one that isn't empty. No room for a difference means equal sets:
    one class, no token.
    """
    most = first[np.minimum(band + 1, len(first) - 1)] - 1
    differ = differing(most, most, percent)
    share = int(np.ceil(200 * np.exp(-(100 + percent) / max(2 * (100 - percent), 1))))
    return np.where(differ > 0, differ + 4 + (differ + 1) * share // 100, 0), most


def coarse_tokens(
    doc: np.ndarray, value: np.ndarray, rows: int, percent: int, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Row and coarse token of the distinct shingles (`doc`, `value`) of `rows` texts; `common` is sorted.

    A set with more parts that aren't empty than it may differ by shares one of them with
    every set that it links with. Sets left with too few once the common shingles are out
    also carry tokens of all their shingles, for one another, and sets with too few parts
    even so the tokens of their empty ones.
    """
    firsts = size_bands(percent)
    size = np.bincount(doc, minlength=rows)
    band = np.searchsorted(firsts, size, "right") - 1
    kinds = [(doc, value)]
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, value), len(common) - 1)] != value
        kinds.insert(0, (doc[rare], value[rare]))
    out_rows, out_tokens = [], []
    for here in (band, band + 1):  # a band's pairs meet in its own tokens or in the next band's
        every, most = parts_of(firsts, here, percent)
        few = size > 0
        for kind, (d, v) in enumerate(kinds):
            parts = np.where(few, every, 0)
            first = np.concatenate([[0], np.cumsum(parts)])
            used = parts[d] > 0
            d, v = d[used], v[used]
            salt = textops.mix(here[d].astype(_U) + _U(0x51ED270B + kind))
            slot = first[d] + (textops.mix(v ^ salt) % parts[d].astype(_U)).astype(np.int64)
            total = np.zeros(first[-1], _U)
            np.add.at(total, slot, textops.mix(v + salt))
            filled = np.bincount(slot, minlength=first[-1]) > 0
            owner = np.repeat(np.arange(rows), parts)
            part = np.arange(first[-1]) - first[owner]
            few &= np.bincount(owner, weights=filled, minlength=rows) <= differing(size, most, percent)
            keep = filled | few[owner] if kind == len(kinds) - 1 else filled
            place = textops.mix(part.astype(_U) + textops.mix(here[owner].astype(_U) + _U(7 + kind)))
            out_rows.append(owner[keep])
            out_tokens.append(textops.mix(total + place)[keep])
    return np.concatenate(out_rows), np.concatenate(out_tokens)


def _class_of(doc: np.ndarray, value: np.ndarray, rows: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each row's set, its class and a second digest of the set."""
    size = np.bincount(doc, minlength=rows)
    total, other = np.zeros(rows, _U), np.zeros(rows, _U)
    np.add.at(total, doc, textops.mix(value + _U(seed)))
    np.add.at(other, doc, textops.mix(value ^ _U(0xA0761D6478BD642F)))
    return size, textops.signed(textops.mix(total + size.astype(_U))), textops.signed(other)


def _common_of(value: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several classes of a window hold, whose set sizes (`size` of each entry) differ much, and how many."""
    order = np.argsort(value, kind="stable")
    value, size = value[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    held = np.diff(np.append(first, len(value)))
    if not len(first):
        return value, held
    spread = 5 * np.maximum.reduceat(size, first) >= 8 * np.minimum.reduceat(size, first)
    many = (held >= WINDOW_LEAST) & spread
    return value[first[many]], held[many]


def _common_of_window(window: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """`_common_of` the whole window, worked out for one range of shingles after another: sorting takes the memory of a range."""
    found = []
    for top in range(1 << _RANGE_BITS):
        own = [(v >> _U(64 - _RANGE_BITS)) == _U(top) for v, _ in window]
        value = np.concatenate([v[at] for (v, _), at in zip(window, own, strict=True)])
        size = np.concatenate([s[at] for (_, s), at in zip(window, own, strict=True)])
        found.append(_common_of(value, size))
    shingle, held = (np.concatenate(x) for x in zip(*found, strict=True))
    return shingle, held


def _sets(k: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds set size, class and second digest to rows in place of the text, the last column.

    The first of the rows that close a window also gets the window's common shingles.
    """
    held_type = pa.struct([("shingle", pa.int64()), ("held", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        window: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: pa.RecordBatch | None = None

        def closed(rows: pa.RecordBatch) -> pa.RecordBatch:
            shingle, held = _common_of_window(window)
            window.clear()
            entries = pa.StructArray.from_arrays(
                [pa.array(textops.signed(shingle), pa.int64()), pa.array(held, pa.int64())], fields=list(held_type)
            )
            offs = np.full(rows.num_rows + 1, len(shingle), np.int32)
            offs[0] = 0
            return rows.append_column("common", pa.ListArray.from_arrays(pa.array(offs, pa.int32()), entries))

        for batch in batches:
            at = batch.num_columns - 1
            for lo, hi, data, offsets in textops.slices(batch.column(at)):
                if waiting is not None:
                    if sum(len(v) for v, _ in window) >= WINDOW_SHINGLES:
                        yield closed(waiting)
                    else:
                        yield waiting.append_column("common", pa.nulls(waiting.num_rows, pa.list_(held_type)))
                doc, value = textops.Words(data, offsets, textops.SPACED).shingles(k)
                size, cls, check = _class_of(doc, value, hi - lo, seed)
                own = _fresh(cls, size, seen)[doc]
                window.append((value[own], size[doc[own]].astype(np.int32)))
                waiting = pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(lo, hi - lo) for i in range(at)),
                        pa.array(size, pa.int64()),
                        pa.array(cls, pa.int64(), mask=size == 0),
                        pa.array(check, pa.int64(), mask=size == 0),
                    ],
                    names=[*batch.schema.names[:at], "size", "cls", "check"],
                )
        if waiting is not None:
            yield closed(waiting)

    return run


def _fresh(cls: np.ndarray, size: np.ndarray, seen: set[int]) -> np.ndarray:
    """Rows whose class the task meets for the first time."""
    fresh = np.zeros(len(cls), bool)
    for i in np.flatnonzero(size):
        if int(cls[i]) not in seen:
            seen.add(int(cls[i]))
            fresh[i] = True
    return fresh


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` places the smallest one that links from `a` to `b` reach."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (before == root).all():
            return root


def _tokens(k: int, percent: int, seed: int, common: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(`token`, `cls`): a batch gives each of its tokens once, whichever classes share it.

    Classes that tokens hold together within the batch share a token of the batch's own,
    so a token has a row a batch at most and the batch's own tokens a row a class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            classes, tokens = [], []
            for lo, hi, data, offsets in textops.slices(batch.column(0), TOKEN_BYTES):
                doc, value = textops.Words(data, offsets, textops.SPACED).shingles(k)
                size, cls, _ = _class_of(doc, value, hi - lo, seed)
                own = _fresh(cls, size, seen)[doc]
                owner, token = coarse_tokens(doc[own], value[own], hi - lo, percent, common)
                classes.append(cls[owner])
                tokens.append(token)
            cls, token = np.concatenate(classes or [np.zeros(0, np.int64)]), np.concatenate(tokens or [np.zeros(0, _U)])
            if not len(token):
                continue
            name, place = np.unique(cls, return_inverse=True)
            order = np.lexsort((place, token))
            token, place = token[order], place[order]
            again = np.zeros(len(token), bool)
            again[1:] = token[1:] == token[:-1]
            root = _roots(place[np.flatnonzero(again) - 1], place[again], len(name))
            held = np.flatnonzero(np.bincount(root, minlength=len(name))[root] > 1)
            salt = textops.mix(np.array([name.view(_U).sum(), len(name)], _U)).sum()
            private = textops.mix(name[root[held]].view(_U) ^ salt)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(textops.signed(np.concatenate([token[~again], private])), pa.int64()),
                    pa.array(name[np.concatenate([place[~again], held])], pa.int64()),
                ],
                names=["token", "cls"],
            )

    return run


def _shingles(k: int, seed: int, wanted: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Class and shingles of the texts whose hash may be wanted, each class once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(wanted, batch.column(0).to_numpy())))
            for lo, hi, data, offsets in textops.slices(batch.column(1)):
                doc, value = textops.Words(data, offsets, textops.SPACED).shingles(k)
                size, cls, _ = _class_of(doc, value, hi - lo, seed)
                new = _fresh(cls, size, seen)
                found = textops.lists(textops.signed(value[new[doc]]), size[new], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(cls[new], pa.int64()), found], names=["cls", "shingles"])

    return run


def _leads(percent: int, common: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each class's smallest coarse token (`lead`) in place of its shingles, the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 1
            owner, token = coarse_tokens(*_entries(batch.column(at)), batch.num_rows, percent, common)
            lead = np.full(batch.num_rows, np.iinfo(np.uint64).max, _U)
            np.minimum.at(lead, owner, token)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(textops.signed(lead), pa.int64())], names=[*batch.schema.names[:at], "lead"]
            )

    return run


def _part_tokens(percent: int, common: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(`token`, `part`): the coarse tokens of each part's members, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sets = batch.column(1)[i].values.field("shingles")
                token = np.unique(coarse_tokens(*_entries(sets), len(sets), percent, common)[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(textops.signed(token), pa.int64()),
                        pa.array(np.full(len(token), batch.column(0)[i].as_py()), pa.int64()),
                    ],
                    names=["token", "part"],
                )

    return run


def _entries(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each entry's set, and the entry."""
    return np.repeat(np.arange(len(sets)), np.diff(sets.offsets.to_numpy())), sets.flatten().to_numpy().view(_U)


class _Group:
    """Members of a group: class, copies, sorted shingles."""

    def __init__(self, members: pa.StructArray):
        self.cls = members.field("cls").to_numpy()
        self.copies = members.field("copies").to_numpy()
        sets = members.field("shingles")
        self.size = np.diff(sets.offsets.to_numpy())
        self.value = sets.flatten().to_numpy()
        self.member = np.repeat(np.arange(len(self.cls)), self.size)
        self.order = np.argsort(self.value, kind="stable")
        self.sorted = self.value[self.order]


def _open(a: _Group, b: _Group, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of queries in `a` to members of `b`: places and common shingles. Only groups whose union may hold enough are opened."""
    lo = np.searchsorted(b.sorted, a.value, "left")
    found = np.searchsorted(b.sorted, a.value, "right") - lo
    bound = np.bincount(a.member, weights=found > 0, minlength=len(a.cls))
    open_ = 100 * bound >= percent * a.size
    work = (np.bincount(a.member, weights=found, minlength=len(a.cls)) + len(b.cls)) * open_
    step = (np.cumsum(work) // _STEP).astype(np.int64)
    for s in np.unique(step[open_]):
        queries = np.flatnonzero(open_ & (step == s))
        place = np.full(len(a.cls), -1)
        place[queries] = np.arange(len(queries))
        entry = np.flatnonzero(place[a.member] >= 0)
        times = found[entry]
        first = np.repeat(lo[entry] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        member = b.member[b.order[first]]
        pair = np.repeat(place[a.member[entry]], times) * len(b.cls) + member
        common = np.bincount(pair, minlength=len(queries) * len(b.cls)).reshape(len(queries), len(b.cls))
        union = a.size[queries][:, None] + b.size[None, :] - common
        linked = (100 * common >= percent * union) & (common > 0)
        if same:
            linked &= queries[:, None] < np.arange(len(b.cls))[None, :]
        q, m = np.nonzero(linked)
        yield queries[q], m, common[q, m]


def _parts() -> Column:
    """How many tasks the sets of a group (`size`) fill."""
    return F.ceil(F.greatest(F.sum("size") / F.lit(GROUP_SHINGLES), F.count("*") / F.lit(GROUP_MEMBERS)))


def _verify(percent: int, pairs: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Opens pairs of groups. Gives either every link, or for each class with links its number of linked documents and a root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = []
            for i in range(batch.num_rows):
                same = batch.column(0)[i].as_py()
                a = _Group(batch.column(1)[i].values)
                b = a if same else _Group(batch.column(2)[i].values)
                found = [x for x in _open(a, b, percent, same) if len(x[0])]
                if not found:
                    continue
                q, m, common = (np.concatenate(x) for x in zip(*found, strict=True))
                if pairs:
                    out.append([a.cls[q], b.cls[m], common, a.size[q] + b.size[m] - common])
                    continue
                cls = np.concatenate([a.cls, b.cls])
                links = np.concatenate([np.bincount(q, b.copies[m], len(a.cls)), np.bincount(m, a.copies[q], len(b.cls))])
                right = m + len(a.cls)
                if same:
                    cls, right = a.cls, m
                    links = links[: len(a.cls)] + links[len(a.cls) :]
                root = _roots(q, right, len(cls))
                has = links > 0
                out.append([cls[has], cls[root[has]], links[has].astype(np.int64)])
            names = ["a", "b", "common", "together"] if pairs else ["cls", "root", "links"]
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


class JaccardJoin:
    """Links between texts whose shingle sets have a Jaccard similarity of `percent` / 100 or more.

    `docs` needs the columns `id_col` and `text_col`; others, whatever their names,
    are ignored. A set holds the distinct `k`-word shingles of the whole text with
    A-Z in lower case; words are runs without blanks and the controls 9 to 13. A text
    of fewer words has its whole sequence as one shingle; null and empty texts have
    an empty set and link with nothing. Rows with equal sets form a class; repeated
    rows and ids, and null ids, are kept as they are. An empty table gives empty tables.

    Classes are named by 64 bits of their set; a second digest shows whether two sets
    share a name, and then the names are dealt anew.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80):
        if not 0 < percent <= 100 or k < 1:
            raise ValueError("percent must lie in 1..100 and k must be positive")
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).alias("id"), F.md5(text_col).alias("key"), F.col(text_col).alias("text"))
        schema = T.StructType(
            [
                *(T.StructField(n, self.docs.schema[n].dataType) for n in ("id", "key")),
                *(T.StructField(n, T.LongType()) for n in ("size", "cls", "check")),
                T.StructField("common", T.DataType.fromDDL("array<struct<shingle:bigint,held:bigint>>")),
            ]
        )
        self._opened: DataFrame | None = None
        for self.seed in range(0x9E37, 0x9E37 + 9):
            self.members = materialize(in_arrow(self.docs, _sets(k, self.seed), schema), "jaccard-members")
            self.classes = materialize(
                self.members.where("size > 0")
                .groupBy("cls")
                .agg(
                    F.count("*").alias("copies"),
                    F.min("id").alias("first_id"),
                    F.min("size").alias("size"),
                    F.min(F.xxhash64("key")).alias("text_hash"),
                    ((F.min("check") != F.max("check")) | (F.min("size") != F.max("size"))).alias("clash"),
                ),
                "jaccard-classes",
            )
            if not self.classes.where("clash").limit(1).count():
                return
        raise RuntimeError("no seed gave every set a name of its own")

    def _group_pairs(self) -> DataFrame:
        """`same`, `left`, `right`: the members of each group, and of every two parts of one that the matrix can't rule out."""
        if self._opened is None:
            self._opened = self._find_pairs()
        return self._opened

    def _find_pairs(self) -> DataFrame:
        least = max(LEAST_COMMON, int(COMMON_SHARE * self.classes.count()))
        found = (
            self.members.select(F.inline("common"))
            .groupBy("shingle")
            .agg(F.sum("held").alias("held"))
            .where(F.col("held") >= least)
            .orderBy(F.desc("held"), "shingle")
            .limit(MOST_COMMON)
            .toArrow()
        )
        common = np.sort(found.column("shingle").to_numpy().astype(np.int64).view(_U))
        tokens = in_arrow(
            self.docs.select("text"), _tokens(self.k, self.percent, self.seed, common), "token long, cls long"
        )
        before = F.lag("cls").over(Window.partitionBy("token").orderBy("cls"))
        held = materialize(
            tokens.withColumn("near", before).where("near <> cls").select("cls", "near").distinct(), "jaccard-held"
        )
        similar = materialize(
            components(held, "cls", "near")
            .withColumnRenamed("node", "cls")
            .join(self.classes.select("cls", "copies", "size", "text_hash"), "cls"),
            "jaccard-similar",
        )
        whole = similar.groupBy("root").agg(_parts().alias("cuts"))
        wanted = bitmap(similar, "text_hash")
        shingles = in_arrow(
            self.docs.select(F.xxhash64("key").alias("h"), "text"),
            _shingles(self.k, self.seed, wanted),
            "cls long, shingles array<long>",
        )
        sets = materialize(
            shingles.groupBy("cls")
            .agg(F.first("shingles").alias("shingles"))
            .join(similar.join(whole, "root").select("cls", "copies", "size", "root", "cuts"), "cls"),
            "jaccard-sets",
        )
        large = sets.where("cuts > 1")
        lead = materialize(
            in_arrow(
                large.select("cls", "root", "size", "cuts", "shingles"),
                _leads(self.percent, common),
                "cls long, root long, size long, cuts long, lead long",
            ),
            "jaccard-leads",
        )
        fine = lead.groupBy("root", "lead").agg(_parts().alias("again"))
        cut = lead.join(fine, ["root", "lead"]).select(
            "cls",
            F.xxhash64("root", F.expr("pmod(xxhash64(lead), cuts)"), F.when(F.col("again") > 1, F.expr("xxhash64(lead, pmod(xxhash64(cls), again))"))).alias("part"),
        )
        cut = materialize(cut, "jaccard-parts")
        members = F.collect_list(F.struct("cls", "copies", "shingles")).alias("members")
        entire = sets.where("cuts = 1").groupBy("root").agg(members).select("members")
        parts = materialize(large.join(cut, "cls").groupBy("part").agg(members), "jaccard-part-sets")
        matrix = materialize(in_arrow(parts, _part_tokens(self.percent, common), "token long, part long"), "jaccard-matrix")
        pairs = (
            matrix.select("token", F.col("part").alias("p1"))
            .join(matrix.select("token", F.col("part").alias("p2")), "token")
            .where("p1 < p2")
            .select("p1", "p2")
            .distinct()
        )
        left = parts.select(F.col("part").alias("p1"), F.col("members").alias("left"))
        right = parts.select(F.col("part").alias("p2"), F.col("members").alias("right"))
        alone = entire.union(parts.select("members")).select(
            F.lit(True).alias("same"), F.col("members").alias("left"), F.lit(None).cast(parts.schema["members"].dataType).alias("right")
        )
        return alone.union(pairs.join(left, "p1").join(right, "p2").select(F.lit(False), "left", "right"))

    def pairs(self) -> DataFrame:
        """Every link between two classes: `a`, `b`, number of `common` shingles and of shingles `together`."""
        return in_arrow(self._group_pairs(), _verify(self.percent, True), "a long, b long, common long, together long")

    def per_document(self) -> DataFrame:
        """Each row's `id`, `key` (md5 of the text), `size` of its set, `cls`, number of `links`, component (`root`) and the smallest id in it (`component_id`)."""
        links = materialize(
            in_arrow(self._group_pairs(), _verify(self.percent, False), "cls long, root long, links long"), "jaccard-links"
        )
        roots = components(links, "cls", "root")
        counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
        known = materialize(
            self.classes.join(counts, "cls", "left")
            .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
            .select(
                "cls",
                "first_id",
                F.coalesce("root", "cls").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            ),
            "jaccard-roots",
        )
        first = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
        found = materialize(known.join(first, "root").select("cls", "links", "root", "component_id"), "jaccard-known")
        return self.members.select("id", "key", "size", "cls").join(found, "cls", "left").select(
            "id",
            "key",
            "size",
            "cls",
            F.coalesce("links", F.lit(0)).alias("links"),
            "root",
            F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
