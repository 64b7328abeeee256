"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

Two words one edit apart share their first half or their last half. So every word is looked for
in the sorted vocabulary among the words with its first half, and in the sorted list of the
reversed words among those with its last half. A scan keeps the rows of the banded edit matrix
of the word so far, takes up at the prefix that neighbouring entries share, and jumps over all
entries with a prefix that is more than one edit away.

The lists are cut at prefixes into pieces of at most `most` words, however many words begin alike, and
pieces stand on shelves, of which a task holds one at a time. Words are sent to the shelves with a
piece whose prefix is within one edit.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.tasks import in_arrow
from orderflow.workspace import materialize

# What a run of letters is, shortest word, least count, share of deletions, ratio of a form's count.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
SHORTEST = 7
LEAST = 2
ONE_IN = 31
RATIO = 10
#: Words of a piece of a sorted list at most.
PIECE_WORDS = 10_000
#: Words of a shelf, which holds whole pieces, about; a task holds one shelf at a time.
SHELF_WORDS = 20_000
#: Words looked up at a time.
BLOCK = 8_192
#: Behind every letter, so that prefix + _LAST ends the range of a prefix.
_LAST = chr(0x10FFFF)
#: Letters that the halves of two words near to each other share at least; pieces begin with as many.
_HEAD = 3


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`word`: each run of at least `SHORTEST` letters left after deletions, in lower case (A-Z only).

    One run in 31, by the checksum of id and run, loses one letter. A null id counts as empty, a null text has no runs.
    """
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    long = found.where(F.length("run") >= SHORTEST)
    hashed = long.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    left = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, left).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= SHORTEST)


def vocabulary(words: DataFrame) -> DataFrame:
    """`word` and its count `n`, of words that occur `LEAST` times."""
    return words.where("word is not null").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)


def half(shorter: int, longer: int) -> int:
    """Letters that two near words of these lengths share at their beginning or, if not there, at their end."""
    return (longer - 1 if shorter == longer else longer) // 2


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words behind one another, and where each word begins and how long it is."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    return flat, np.cumsum(size) - size, size


class Scan:
    """Sorted entries to look words up in, with the length of the prefix each shares with the one before.

    Entries with a common prefix are a range. The rows of the edit matrix belong to a word and such a
    range, so they are worked out once for all its entries, and for a block of words at a time.
    """

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.flat, self.first, self.size = _letters(entries)
        self.shared = np.zeros(len(entries), np.int64)
        alive, d = np.arange(1, len(entries)), 0
        while len(alive):
            alive = alive[(self.size[alive] > d) & (self.size[alive - 1] > d)]
            alive = alive[self.flat[self.first[alive] + d] == self.flat[self.first[alive - 1] + d]]
            d += 1
            self.shared[alive] = d
        #: Ranges looked at, to tell how much was skipped.
        self.opened = 0

    def near(self, words: list[str], exact: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of words and of entries at most one edit from them, and the length of the prefix both share.

        With `whole` false, entries at most one edit from a beginning of the word. The first `exact[i]` letters
        of a word and its entry must be equal. Row d of the edit matrix belongs to the first d letters of a range
        and has three cells, for d - 1, d and d + 1 letters of the word; 2 stands for two and more.
        """
        flat, first, size = _letters(words)
        flat = np.append(flat, np.uint32(0))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def letter(word: np.ndarray, at: int) -> np.ndarray:
            """The letter at a place of each word; 0, which no entry holds, outside of it."""
            inside = (size[word] > at) & (at >= 0)
            return np.where(inside, flat[np.where(inside, first[word] + at, len(flat) - 1)], 0)

        d = int(exact.min(initial=1 << 30)) if len(words) else 0
        ranges = {w[:d]: (bisect_left(self.entries, w[:d]), bisect_left(self.entries, w[:d] + _LAST)) for w in words}
        lo, hi = np.array([ranges[w[:d]] for w in words], np.int64).reshape(-1, 2).T
        word = np.flatnonzero((lo < hi) & (size >= d))
        lo, hi = lo[word], hi[word]
        less, same, more = (np.full(len(word), v, np.int8) for v in (1 if d else 2, 0, 1))
        prefix = np.full(len(word), d)
        while len(word):
            hit = self.size[lo] == d
            if whole:
                last = np.choose(np.clip(size[word] - d + 1, 0, 2), [less, same, more]) < 2
                hit &= last & (np.abs(size[word] - d) < 2)
            if hit.any():
                found.append((word[hit], lo[hit], prefix[hit]))
            # Ranges of d + 1 letters inside those of d letters.
            cuts = np.flatnonzero(self.shared <= d)
            starts = cuts[self.size[cuts] > d]
            a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            parent = np.repeat(np.arange(len(word)), b - a)
            lo = starts[np.arange(len(parent)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[parent]]
            hi = np.append(cuts, len(self.entries))[np.searchsorted(cuts, lo, "right")]
            word, less, same, more, prefix = word[parent], less[parent], same[parent], more[parent], prefix[parent]
            self.opened += len(word)
            own, n = self.flat[self.first[lo] + d], size[word]
            d += 1
            left = np.minimum(same + 1, less + (letter(word, d - 2) != own))
            left = np.where((d - 1 <= n) & (left < 2), left, 2)
            mid = np.minimum(np.minimum(same + (letter(word, d - 1) != own), more + 1), left + 1)
            mid = np.where((d <= n) & (mid < 2), mid, 2)
            right = np.minimum(more + (letter(word, d) != own), mid + 1)
            right = np.where((d + 1 <= n) & (right < 2), right, 2)
            # A range whose prefix is more than one edit away is skipped with all its entries.
            keep = ((left < 2) | (mid < 2) | (right < 2)) & ((mid == 0) | (d > exact[word]))
            word, lo, hi, prefix = word[keep], lo[keep], hi[keep], prefix[keep]
            less, same, more = (x[keep].astype(np.int8) for x in (left, mid, right))
            prefix[same == 0] = d
        if not found:
            nothing = np.zeros(0, np.int64)
            return nothing, nothing, nothing
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _shelf(piece: str, shelves: int) -> int:
    return zlib.crc32(piece.encode()) % shelves


def _route(split: list[str], shelves: int):
    """Task that sends each word to the shelves it must be looked up in; `split` lists the pieces of cut heads."""
    heads: dict[str, Scan] = {head: Scan(list(group)) for head, group in groupby(split, key=lambda p: p[:_HEAD])}

    def run(batches):
        for batch in batches:
            cut: dict[str, list[str]] = {}
            sent = []
            for word in batch.column("key").to_pylist():
                if (head := word[:_HEAD]) in heads:
                    cut.setdefault(head, []).append(word)
                else:
                    sent.append((_shelf(head, shelves), word))
            for head, words in cut.items():
                scan = heads[head]
                at, place, _ = scan.near(words, np.full(len(words), _HEAD), whole=False)
                sent += {(_shelf(scan.entries[j], shelves), words[i]) for i, j in zip(at.tolist(), place.tolist(), strict=True)}
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in sent], pa.int32()), pa.array([x[1] for x in sent], pa.string())], ["shelf", "key"])

    return run


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _near(scan: Scan, counts: list[int], keys: list[str], back: bool) -> pa.RecordBatch:
    """Number of near words and the first of them by count for each key that has any in this list."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    best: dict[int, list] = {}
    at, place, prefix = scan.near(keys, (size - 1) // 2)
    for i, j, p in zip(at.tolist(), place.tolist(), prefix.tolist(), strict=True):
        key, other = keys[i], scan.entries[j]
        m = half(*sorted((len(key), len(other))))
        # Pairs that share their first half belong to the forward list, the others to the list of reversed words.
        if key == other or p < m or back and key[-m:] == other[-m:]:
            continue
        word = other[::-1] if back else other
        if (known := best.get(i)) is None:
            best[i] = [1, counts[j], word]
            continue
        known[0] += 1
        if (-counts[j], word) < (-known[1], known[2]):
            known[1:] = counts[j], word
    rows = {"word": [keys[i][::-1] if back else keys[i] for i in best]}
    rows |= {name: [b[k] for b in best.values()] for k, name in enumerate(("n_near", "form_n", "form"))}
    return pa.RecordBatch.from_pydict(rows, schema=_FOUND)


def _search(batches):
    """Near words of the looked-up words of each shelf; a shelf's entries come first, sorted, then the words."""
    shelf, entries, counts, scan = None, [], [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("back", "shelf", "asks", "key", "n")]
        keys: list[str] = []
        for back, at, asks, key, n in zip(*columns, strict=True):
            if shelf != (back, at):
                if keys:
                    yield _near(scan, counts, keys, shelf[0])
                shelf, entries, counts, scan, keys = (back, at), [], [], None, []
            if not asks:
                entries.append(key)
                counts.append(n)
                continue
            if scan is None:
                scan = Scan(entries)
            keys.append(key)
            if len(keys) == BLOCK:
                yield _near(scan, counts, keys, back)
                keys = []
        if keys:
            yield _near(scan, counts, keys, shelf[0])


def _heavy(placed: DataFrame, most: int) -> DataFrame:
    counts = placed.groupBy("back", "piece").count().where(F.col("count") > most)
    return materialize(counts.select("back", "piece"), "spelling-heavy")


def pieces(lists: DataFrame, most: int) -> tuple[DataFrame, dict[bool, list[str]]]:
    """`lists` (`back`, `key`, `n`) with the `piece` of each entry, and the pieces of each list's cut heads.

    A piece is a prefix that at most `most` entries have, one letter longer than a prefix that more of
    them have. Heads that aren't cut need no list; the others have about entries / `most` pieces, which is
    what reaches the driver.
    """
    placed = materialize(lists.withColumn("piece", F.substring("key", 1, _HEAD)), "spelling-lists")
    heavy = _heavy(placed, most)
    split: dict[bool, list[str]] = {False: [], True: []}
    rest, done, width = placed, None, _HEAD
    while heavy.limit(1).count():
        inside = rest.join(heavy, ["back", "piece"], "left_semi")
        light = rest.join(heavy, ["back", "piece"], "left_anti")
        done = light if done is None else done.unionByName(light)
        width += 1
        longer = F.substring(F.col("key"), F.lit(1), F.lit(width))
        rest = materialize(inside.withColumn("piece", longer), "spelling-pieces")
        heavy = _heavy(rest.where(F.length("piece") == width), most)
    if done is None:
        return placed, split
    every = done.unionByName(rest)
    for row in every.where(F.length("piece") > _HEAD).select("back", "piece").distinct().toLocalIterator():
        split[row["back"]].append(row["piece"])
    return every, {side: sorted(found) for side, found in split.items()}


def near_words(words: DataFrame, most: int = PIECE_WORDS) -> DataFrame:
    """`word`, `n_near`, `form_n`, `form` for words of (`word`, `n`) that have near words.

    `form` is the near word of the largest count, the smallest of several. Words are distinct and of `SHORTEST`
    letters at least. Pairs are counted where they are found and never listed.
    """
    lists = words.select(F.lit(False).alias("back"), F.col("word").alias("key"), "n").unionByName(
        words.select(F.lit(True).alias("back"), F.reverse("word").alias("key"), "n")
    )
    placed, split = pieces(lists, most)
    shelves = max(1, 2 * words.count() // SHELF_WORDS)
    entries = placed.select("back", (F.crc32("piece") % shelves).cast("int").alias("shelf"), F.lit(False).alias("asks"), "key", "n")
    asked = None
    for back in (False, True):
        sent = in_arrow(lists.where(F.col("back") == F.lit(back)).select("key"), _route(split[back], shelves), "shelf int, key string")
        sent = sent.select(F.lit(back).alias("back"), "shelf", F.lit(True).alias("asks"), "key", F.lit(None).cast("long").alias("n"))
        asked = sent if asked is None else asked.unionByName(sent)
    rows = entries.unionByName(asked)
    order = rows.repartition(2 * shelves, "back", "shelf").sortWithinPartitions("back", "shelf", "asks", "key")
    found = in_arrow(order, _search, "word string, n_near long, form_n long, form string")
    ranked = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("first"))
    return ranked.select("word", "n_near", (-F.col("first.less")).alias("form_n"), F.col("first.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """`word` and the last `root` that (`word`, `form`) leads to.

    Counts grow tenfold with every step, so chains are short; each round halves them.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(onward, "root", "left")
        moved = materialize(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return reached


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = PIECE_WORDS) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` for the vocabulary of whole texts.

    Words are the runs of letters (see `runs`) of 7 letters at least that occur twice. A word's form is its near
    word of the largest count, if that is ten times its own; its root is the end of that chain, or itself. Nulls
    hold no words, repeated rows count again, other columns are ignored, and an empty table gives no rows.
    """
    words = materialize(vocabulary(runs(docs, id_col, text_col)), "spelling-words")
    near = near_words(words, most)
    joined = words.join(near, "word", "left")
    strong = F.col("form_n") >= RATIO * F.col("n")
    found = materialize(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("form")).alias("form"),
            F.when(strong, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce(F.col("root"), F.col("word")))
