"""Secret scan: patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax into pairs of a name and a literal,
follows constants that other names are set to, and scores each literal by how sensitive
its name is and how much it looks like a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.tasks import in_arrow

# The patterns of the base spans.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer fails, and a run is matched whole
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

KINDS = ("assign", "access", "hex", "pair")

#: How far a part of a name says that its value is a secret.
SENSITIVE = {
    "password": 0.95, "passwd": 0.95, "pwd": 0.9, "passphrase": 0.95, "secret": 0.9, "token": 0.8, "apikey": 0.9,
    "credential": 0.8, "credentials": 0.8, "private": 0.5, "auth": 0.5, "bearer": 0.7, "key": 0.5, "api": 0.3,
    "access": 0.3, "signing": 0.4, "encryption": 0.4, "salt": 0.5, "pin": 0.4, "cookie": 0.4, "session": 0.3,
}
#: Parts that say the value only describes or points to a secret.
HARMLESS = {"public", "name", "file", "path", "url", "uri", "length", "len", "type", "count", "expiry", "hint", "label", "field", "policy", "size"}
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|nil|true|false|todo|changeme|change_me|example|sample|test|dummy|your[_-].*|<.*>|\$.*|%.*%)$")

STRINGS = {'"': r'"(?:[^"\\\n]|\\.)*+"', "'": r"'(?:[^'\\\n]|\\.)*+'", "`": r"`[^`\n]*+`"}
TOKEN = (
    r"""(?P<name>[A-Za-z_$][\w$]*+(?:[.-][\w$]++)*+)"""
    r"""|(?P<set>:=|=>|=(?!=)|:(?![:/]))"""
    r"""|(?P<plus>\+)"""
    r"""|(?P<other>[^\s\w"'`$]|[^\s"'`]++)"""
)
#: Code points of a value, pieces added up; anything longer is data and no secret.
LONGEST = 4096
BARE = re.compile(r"""[^\s,;"'`(){}\[\]<>]++""")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """0 to 1: several telling parts add up, a harmless last part all but cancels them."""
    parts = [p.lower() for p in PARTS.findall(name)]
    clear = 1.0
    for p in parts:
        clear *= 1 - SENSITIVE.get(p, 0.0)
    return (1 - clear) * (0.2 if parts and parts[-1] in HARMLESS or "public" in parts else 1.0)


def literal_score(text: str) -> float:
    """0 to 1 by length, variety of characters and entropy; prose, placeholders, short and very long values give 0."""
    if not 6 <= len(text) <= LONGEST or PLACEHOLDERS.match(text) or any(c.isspace() for c in text):
        return 0.0
    n = len(text)
    entropy = -sum(v / n * math.log2(v / n) for v in Counter(text).values())
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.25 * min(n, 20) / 20 + 0.5 * min(entropy, 4) / 4 + 0.25 * min(kinds, 3) / 3)


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the lines that hold a sign of assignment."""
    for m in re.finditer(r"[^\n]*+", text):
        if m.end() > m.start() and ("=" in (line := m.group()) or ":" in line):
            yield m.start(), m.end()


def _lexer(unclosed: str) -> re.Pattern:
    """Tokens of a line on which the quotes `unclosed` don't close any more; a further such quote is token `open`."""
    strings = [p for q, p in STRINGS.items() if q not in unclosed]
    quotes = "".join(q for q in STRINGS if q not in unclosed)
    return re.compile("|".join([*([f"(?P<string>{'|'.join(strings)})"] if strings else []), TOKEN, *([f"(?P<open>[{quotes}])"] if quotes else [])]))


LEXERS = {"".join(sorted(some)): _lexer("".join(some)) for n in range(4) for some in combinations(STRINGS, n)}


def _tokens(text: str, lo: int, hi: int) -> list[tuple[str, int, int]]:
    """Kind and bounds of the tokens of a line.

    Behind a quote that nothing closes all quotes of its kind are escaped, so none of them
    opens a string either; each kind is looked for in vain once a line.
    """
    tokens, unclosed = [], ""
    while lo < hi:
        for m in LEXERS[unclosed].finditer(text, lo, hi):
            if m.lastgroup == "open":
                unclosed, lo = "".join(sorted(unclosed + m.group())), m.end()
                break
            tokens.append((m.lastgroup, m.start(), m.end()))
        else:
            break
    return tokens


def pairs(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Each name that is set to literals, and the literals with their bounds, in the order of the text.

    A name that is set to a constant of the text gets that constant's literals. Values of more
    than `LONGEST` code points, literals of constants included, give no pair, so what a
    constant holds is bounded.
    """
    constants: dict[str, list[tuple[str, int, int]] | None] = {}
    for lo, hi in _lines(text):
        tokens = _tokens(text, lo, hi)
        starts = [t[1] for t in tokens]
        run_lo = run_hi = lo  # the bare run that was found last
        for i, (kind, _, end) in enumerate(tokens):
            if kind != "set" or not i or tokens[i - 1][0] not in ("name", "string"):
                continue
            left = i - 1
            if i >= 3 and text[tokens[i][1]] == "=" and tokens[i - 2][0] == "set" and tokens[i - 3][0] == "name":
                left = i - 3  # name: type = value
            literals: list[tuple[str, int, int]] = []
            size, j, at = 0, i + 1, end
            while j < len(tokens) and size <= LONGEST:
                kind, a, b = tokens[j]
                if kind == "string":
                    size += b - a - 1  # an empty string counts too
                    if size <= LONGEST:
                        literals.append((text[a + 1 : b - 1], a + 1, b - 1))
                    j += 1
                else:
                    while at < hi and text[at] in " \t":
                        at += 1
                    if not run_lo <= at < run_hi:
                        bare = BARE.match(text, at, hi)
                        if not bare:
                            break
                        run_lo, run_hi = bare.span()
                    b = run_hi
                    if b < hi and text[b] in "([{":  # a call or an index is no literal
                        break
                    if b - at > LONGEST:
                        size += b - at
                        break
                    word = text[at:b]
                    held = constants.get(word, [(word, at, b)])
                    size += LONGEST + 1 if held is None else sum(max(1, len(x)) for x, _, _ in held)
                    if size <= LONGEST:
                        literals.extend(held)
                    j = bisect_left(starts, b, j)
                at = b
                if j + 1 < len(tokens) and tokens[j][0] == "plus" and literals:
                    at, j = tokens[j][2], j + 1
                    continue
                break
            if literals or size > LONGEST:
                name = text[tokens[left][1] : tokens[left][2]].strip("\"'`")
                constants[name] = literals if size <= LONGEST else None
                if size <= LONGEST:
                    yield name, literals


def spans(text: str | None, least: float = 0.6) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and spans of scored pairs, (kind, start, end) in code points, by start and then kind.

    Base spans are whole matches, leftmost and not overlapping within a kind; null has none.
    """
    text = text or ""
    low = text.lower()
    base = []
    if any(k in low for k in KEYWORDS):
        base += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found = set()
    if "=" in text or ":" in text:
        for name, literals in pairs(text):
            weight = name_score(name)
            if weight and weight * (0.4 + 0.6 * literal_score("".join(x for x, _, _ in literals))) >= least:
                found.update(("pair", a, b) for x, a, b in literals if literal_score(x) or len(literals) > 1)
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(found, key=order)


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _found(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, more = spans(value.as_py(), least)
                both = [(*s, True) for s in base] + [(*s, False) for s in more]
                both.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                rows.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPAN)], names=["id", "spans"])

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """`id` and `spans` (kind, start, end, base) of every row of `docs`.

    Kinds are assign, access and hex (base) and pair (a literal whose name and looks score
    `least` or more together). Null and empty texts have none; repeated rows each get
    theirs; other columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [rows.schema["id"], T.StructField("spans", T.DataType.fromDDL("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"))]
    )
    return in_arrow(rows, _found(least), schema)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", least: float = 0.6) -> DataFrame:
    """`id` and `text` with every span, overlapping ones as one, replaced by `mark`; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                text = value.as_py()
                parts, at = [], 0
                for _, a, b in sorted((x for both in spans(text, least) for x in both), key=lambda s: (s[1], -s[2])):
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                out.append(None if text is None else "".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_arrow(rows, run, T.StructType([rows.schema["id"], T.StructField("text", T.StringType())]))
