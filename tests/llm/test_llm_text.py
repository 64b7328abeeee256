"""Words, hashes and the fixed-size bitmap."""

import helpers
import numpy as np
import pyarrow as pa
import pytest

from orderflow.llm import textops
from orderflow.llm.membership import bitmap, may_hold

TEXTS = [
    "Hello World hello",
    None,
    "",
    "a b A b a b",
    "é ñ\tX\x0by\x00z~{0",
    "ſK İ 漢字 x",
    "zz" * 700_000 + " q " + "r s " * 400_000,
    " \n\r ",
    "one",
]


@pytest.mark.parametrize(("kind", "pattern"), [(textops.SPACED, helpers.SPACED), (textops.ALNUM, helpers.ALNUM)])
@pytest.mark.parametrize("most", [16, 1 << 22])
def test_words_are_those_of_the_pattern(kind, pattern, most):
    for lo, hi, data, offsets in textops.slices(pa.array(TEXTS), most):
        words = textops.Words(data, offsets, kind)
        of = {}
        for s, e, d, h in zip(words.start, words.end, words.doc, words.hashes[0], strict=True):
            of.setdefault(lo + int(d), []).append((textops.LOWER[data[s:e]].tobytes().decode(), int(h)))
        for i in range(lo, hi):
            assert [w for w, _ in of.get(i, [])] == pattern.findall(helpers.low(TEXTS[i]))
        names = {}
        for found in of.values():
            for w, h in found:
                assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_shingles_are_distinct_and_equal_across_rows(k):
    texts = ["a b c d a b c", "A b c d a b c", "a b", "a  b", None, "x", "a b c d e f"]
    sizes, sets = [], []
    for lo, hi, data, offsets in textops.slices(pa.array(texts), 4):
        doc, value = textops.Words(data, offsets, textops.SPACED).shingles(k)
        for i in range(hi - lo):
            sizes.append(int((doc == i).sum()))
            sets.append(frozenset(value[doc == i].tolist()))
    assert sizes == [len(helpers.shingles(t, k)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(sets[i] & sets[j]) == len(helpers.shingles(a, k) & helpers.shingles(b, k))


def test_bitmap_never_misses_a_key(spark):
    keys = [0, 1, -1, 2**62, -(2**63), 5, 5 + (1 << 24)]
    words = bitmap(spark.createDataFrame([(k,) for k in keys] + [(None,)], "h long"), "h")
    assert may_hold(words, np.array(keys, np.int64)).all()
    assert not may_hold(words, np.array([7, 1 << 20], np.int64)).any()
    assert not may_hold(bitmap(spark.createDataFrame([], "h long"), "h"), np.array(keys, np.int64)).any()
