"""Plain-Python versions that the operators are held to."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = SPACED.findall(low(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard(rows, k, percent):
    """(id, size, links, component) of every (id, text), ids None at the end of a component's order."""
    sets = [shingles(t, k) for _, t in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    part = components(len(rows), links)
    ids = {}
    for i, (key, _) in enumerate(rows):
        ids.setdefault(part[i], []).append(key)
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    least = {p: min((x for x in found if x is not None), default=None) for p, found in ids.items()}
    return [(rows[i][0], len(sets[i]), count[i], least[part[i]]) for i in range(len(rows))]


def contamination(rows, items, window=10):
    """(id, words, hits, item ids) of every (id, text)."""
    windows = {}
    for item, text in items:
        words = ALNUM.findall(low(text))
        if words:
            for i in range(max(1, len(words) - window + 1)):
                windows.setdefault(tuple(words[i : i + window]), set()).add(item)
    out = []
    for key, text in rows:
        words = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        out.append((key, len(words), len(hit), sorted(str(f) for f in found if f is not None)))
    return out
