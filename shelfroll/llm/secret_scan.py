"""Secret scan by assignment-aware lexing.

The base patterns find passwords, access keys and long hexadecimal runs. Beyond them every text is read as source or
configuration, and literals are bound to names:

* ``name = value``, ``name: value``, ``name := value``, ``name => value``; in ``name: type =`` and ``name type =`` the name
  before the type is bound too;
* ``setName(value)`` and ``withName(value)``, and a call or pair whose first argument names the key: ``put("name", value)``;
* markup: ``<name>value</name>``, ``<entry key="name">value</entry>`` and ``<add key="name" value="value"/>``.

A value is a quoted, triple-quoted, back-quoted or prefixed string, a bare literal, a concatenation (``+``, or side by
side in parentheses, over line breaks too), or a name. Constants are propagated: a name on the right-hand side stands
for the literal last bound to it above. A call, an index or a dotted path of plain words is an expression and binds
nothing. A literal is scored by how sensitive the target name is and by how random it looks (one in quotes with blanks
counts without them, for names of weight ``STRONG`` and more); at ``THRESHOLD`` and above its span is reported as kind
``literal`` (for a propagated constant the span of the literal itself, once). Names, types and literals have no length
limit; every part is read forward, or back to the operator before it.

Edge cases: a null text counts as empty; spans are in code points, end exclusive; equal spans of one kind are
reported once; an open quote is a bare literal's first character and binds nothing; other columns are ignored, but a
column that is kept may not be named like one the scan adds (an error); repeated ids keep their rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.6
STRONG = 0.9

#: The base patterns. Letters of the first match in either case, ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hexadecimal digits is matched whole, so shorter runs can be left out

#: Weight of a part of a target name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.8, "apikey": 0.9,
    "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "authorization": 0.7, "bearer": 0.8,
    "key": 0.5, "access": 0.4, "api": 0.4, "salt": 0.5, "signing": 0.5, "encryption": 0.5, "session": 0.4,
    "cookie": 0.4, "jwt": 0.8, "pin": 0.5, "client": 0.2,
}

OPERATOR = re.compile(r"[:=]")
NAME_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
#: A type after a name: words, with brackets, alternatives, references. No digits, so that a value isn't taken for one.
#: Quantifiers are possessive: a type is read once, however long.
_INSIDE = r"[^\n=\"\[\]<>]*+"
for _ in range(4):  # brackets within brackets
    _INSIDE = rf"(?:[^\n=\"\[\]<>]++|[\[<]{_INSIDE}[\]>])*+"
_WORD = rf"(?:[&*]|\[\]|'[a-z]++[ \t]|mut[ \t])*+[A-Za-z_]++(?:(?:\.|::)[A-Za-z_]++)*+(?:[\[<]{_INSIDE}[\]>])?+[?!]?+"
TYPE = rf"{_WORD}(?:[ \t]*+\|[ \t]*+{_WORD})*+"
ANNOTATION = re.compile(rf"[ \t]*+{TYPE}(?:[ \t]++=(?![=>~])|=(?=[\"'`]))", re.ASCII)
MODIFIERS = {"private", "protected", "public", "static", "const", "let", "var", "val", "final", "readonly"}
#: A string with what may stand before it: group 1 to 5 is its inside.
STRING = re.compile(
    r'''(?:[rRbBfFuULwW@$]{1,3}(?=["']))?(?:"""((?:[^"\\]|\\.|"(?!""))*+)"""|'{3}((?:[^'\\]|\\.|'(?!''))*+)'{3}'''
    r'''|"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\]|\\.)*+)`)''',
    re.DOTALL,
)
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*+(?![A-Za-z0-9+/=-])", re.ASCII)
PATH = re.compile(r"[A-Za-z_]++(?:\.[A-Za-z_]++)++", re.ASCII)
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
GAP = re.compile(r"[ \t]*+")
WIDE_GAP = re.compile(r"\s*+")
#: Calls that set what their name says, and calls or pairs whose first part names the key.
SETTER = re.compile(r"(?<![A-Za-z0-9_])(?:set|with)_?([A-Z][A-Za-z0-9_]*+|(?<=_)[a-z][A-Za-z0-9_]*+)\s*+(?=\()", re.ASCII)
KEYED = re.compile(r"""\(\s*+(["'])([A-Za-z_][A-Za-z0-9_.\-]*+)\1\s*+,\s*+""", re.ASCII)
TAG = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:\-]*+)((?:\s[^<>]*+)?)>", re.ASCII)
ATTRIBUTE = re.compile(r"""(?<![A-Za-z0-9_.:\-])(key|name|id|value)\s*+=\s*+(?:"([^"<>]*+)"|'([^'<>]*+)')""", re.ASCII)


def name_weight(name: str) -> float:
    """How sensitive a target name is, 0 to 1: parts at ``_ . -`` and at changes from lower to upper case."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    total = max([0.0, *(SENSITIVE.get(p, 0.0) for p in parts)])
    pairs = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if pairs & {"apikey", "accesskey", "secretkey", "privatekey", "authtoken", "signingkey", "encryptionkey"}:
        total = max(total, 0.9)
    return total


def literal_weight(text: str) -> float:
    """How much a literal looks like a secret, 0 to 1: length, mixed character classes and entropy per character."""
    n = len(text)
    if n < 6 or any(c.isspace() for c in text):
        return 0.0
    counts = Counter(text)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    classes = sum((any(c.islower() for c in text), any(c.isupper() for c in text), any(c.isdigit() for c in text), any(not c.isalnum() for c in text)))
    return min(1.0, 0.2 + 0.15 * (classes - 1) + min(n, 32) / 80 + min(entropy, 4.5) / 12)


def word_before(text: str, at: int) -> tuple[int, int]:
    """Start and end of the name that ends at ``at``; equal where there is none."""
    start = at
    while start and text[start - 1] in NAME_LETTERS:
        start -= 1
    while start < at and text[start] in "0123456789.-":  # a name begins with a letter or underscore
        start += 1
    return start, at


def targets(text: str, at: int) -> list[str]:
    """The name before the operator at ``at``, quotes and an index's bracket in between, and the one before a type."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    close = end
    while close and end - close < 2 and text[close - 1] in "\"']":
        close -= 1
    start, end = word_before(text, close)
    names = [text[start:end]] if start < end else []
    if names and text[at] == "=":  # ``name type =``: the type may have stars and brackets before it
        while start and text[start - 1] in "*&[]":
            start -= 1
        back = start
        while back and text[back - 1] in " \t":
            back -= 1
        if back < start:
            first, last = word_before(text, back)
            if first < last and text[first:last] not in MODIFIERS:
                names.append(text[first:last])
    return names


def pairs(text: str) -> Iterator[tuple[str, int, int]]:
    """(target name, start, end) of every literal bound to a name, constants propagated."""
    bound: dict[str, list[tuple[int, int]]] = {}
    declared: dict[int, str] = {}  # name of a typed declaration, by the place of its "="
    tags = [m for m in TAG.finditer(text) if m[2]] if "<" in text else []
    naming = {text.index("=", a.start()) for m in tags for a in ATTRIBUTE.finditer(text, m.start(2), m.end(2)) if a[1] != "value"}
    over = 0  # operators inside the value last read belong to it
    for m in OPERATOR.finditer(text):
        at = m.start()
        if at < over or at in naming or text[at - 1 : at] in ("=", "!", "<", ">", ":") or text[at + 1 : at + 2] == "/" and text[at] == ":":
            continue
        names = targets(text, at)
        if text[at] == ":" and (typed := ANNOTATION.match(text, at + 1)):
            if names:
                declared[typed.end() - 1] = names[0]
            continue  # a declaration: its "=" binds the name
        if at in declared:
            names.append(declared.pop(at))
        if not names:
            continue
        pos = at + 1
        if text[pos : pos + 1] in ("=", ">"):
            if text[at] == text[pos]:
                continue  # a comparison
            pos += 1
        spans, over = value(text, pos, bound)
        for name in names:
            for start, end in spans:
                yield name, start, end
            bound[name] = spans
    if "(" in text:
        for m in SETTER.finditer(text):
            for start, end in value(text, m.end(), bound)[0]:
                yield m[1], start, end
        for m in KEYED.finditer(text):
            for start, end in value(text, m.end(), bound)[0]:
                yield m[2], start, end
    if "<" in text:
        yield from markup(text)


def markup(text: str) -> Iterator[tuple[str, int, int]]:
    """Pairs of elements and of key and value attributes."""
    for m in TAG.finditer(text):
        named, given = [m[1]], None
        if m[2]:
            for a in ATTRIBUTE.finditer(text, m.start(2), m.end(2)):
                if a[1] == "value":
                    given = a.span(2) if a[2] is not None else a.span(3)
                else:
                    named.append(a[2] if a[2] is not None else a[3])
        if given is not None:
            for name in named[1:]:
                yield name, *given
        start = m.end()
        end = text.find("<", start)
        if end > start and text.startswith(f"</{m[1]}", end):
            inside = text[start:end]
            lead = len(inside) - len(inside.lstrip())
            if inside.strip():
                for name in named:
                    yield name, start + lead, start + lead + len(inside.strip())


def value(text: str, pos: int, bound: dict[str, list[tuple[int, int]]]) -> tuple[list[tuple[int, int]], int]:
    """Spans of the literals that make up the value at ``pos``, and where the value ends."""
    spans: list[tuple[int, int]] = []
    depth = 0
    pos = GAP.match(text, pos).end()
    while text[pos : pos + 1] == "(":
        depth += 1
        pos = WIDE_GAP.match(text, pos + 1).end()
    while True:
        if q := STRING.match(text, pos):
            k = q.lastindex
            spans.append(q.span(k))
        elif (q := NAME.match(text, pos)) and q[0] in bound:
            spans += bound[q[0]]
        elif (q := BARE.match(text, pos)) and not (NAME.fullmatch(q[0]) and text[q.end() : q.end() + 1] in ("(", "[")):
            end = q.end()
            while end > q.start() and text[end - 1] in ".:!?":
                end -= 1
            if end > q.start() and not PATH.fullmatch(text, q.start(), end):
                spans.append((q.start(), end))
            return spans, q.end()
        else:
            return spans, pos
        pos = q.end()
        gap = (WIDE_GAP if depth else GAP).match(text, pos).end()
        while depth and text[gap : gap + 1] == ")":
            depth -= 1
            pos = gap + 1
            gap = (WIDE_GAP if depth else GAP).match(text, pos).end()
        if text[gap : gap + 1] == "+":
            pos = (WIDE_GAP if depth else GAP).match(text, gap + 1).end()
        elif depth and STRING.match(text, gap):  # strings side by side are one
            pos = gap
        else:
            return spans, pos


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def method_spans(text: str, threshold: float = THRESHOLD) -> set[tuple[int, int, int]]:
    """(start, kind number, end) of literals bound to sensitive names."""
    found = set()
    weights: dict[str, float] = {}
    for name, start, end in pairs(text):
        if name not in weights:
            weights[name] = name_weight(name)
        literal = text[start:end]
        if weights[name] >= STRONG and start and text[start - 1] in "\"'`>":
            literal = "".join(literal.split())
        if weights[name] and math.sqrt(weights[name] * literal_weight(literal)) >= threshold:
            found.add((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scanned(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) of ``docs`` with ``_base`` and ``_spans``: arrays of (start, kind, end)."""
    keep = docs.columns if keep is None else keep
    if {"_base", "_spans"} & {*keep}:
        raise ValueError("a column named _base or _spans can't be kept beside those the scan adds")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        as_rows = lambda spans: [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in sorted(spans)]
        for rows in batches:
            base, every = [], []
            for text in rows.column("text").to_pylist():
                found = base_spans(text) if text else []
                base.append(as_rows(found))
                every.append(as_rows({*found, *method_spans(text)} if text else []))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in keep), pa.array(base, kind), pa.array(every, kind)], names=[*keep, "_base", "_spans"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    span = "array<struct<start:int,kind:string,end:int>>"
    return docs.mapInArrow(run, ", ".join([*fields, f"_base {span}", f"_spans {span}"]))


def redacted(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs``, all rows and columns, with every found span of ``text`` replaced by ``mask`` (overlaps by one)."""
    columns = docs.columns
    where = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for text in rows.column("text").to_pylist():
                if text:
                    parts, done = [], 0
                    for s, _, e in sorted({*base_spans(text), *method_spans(text)}):
                        if s >= done:
                            parts += [text[done:s], mask]
                        done = max(done, e)
                    text = "".join([*parts, text[done:]])
                out.append(text)
            arrays = [rows.column(i) for i in range(rows.num_columns)]
            arrays[where] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)


def op3(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract, one row per document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            text_of = lambda spans: ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans)
            for base, every in zip(rows.column("_base").to_pylist(), rows.column("_spans").to_pylist(), strict=True):
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(sum(x["kind"] == k for x in base))
                out["base_sha256"].append(hashlib.sha256(text_of(base).encode()).hexdigest())
                out["spans"].append(text_of(every))
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), **out})

    return scanned(id_and_text(docs), keep=["doc_id"]).mapInArrow(
        digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
