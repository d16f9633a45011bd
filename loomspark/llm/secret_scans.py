"""Secrets in texts: fixed patterns, and literals that an assignment gives to a sensitive name.

The lexer walks over the assignment operators of a text.  Left of each it reads the target name, right of it the
value: string literals and names, joined by ``+``.  Other forms that give a name a literal are read beside it: options of
commands, elements and their name and value attributes, calls that set something by name, and setters.  Names of
literals, and of what is joined from them, are constants, and
a constant that is given to a sensitive name counts like the literal itself.  A value is scored by the words of its
target name and by the shape of its terms, each alone and all joined; what is told are the spans of its literals.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import map_rows

KINDS = ("assign", "access", "hex", "literal")

# Fixed patterns of the base scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

OPERATOR = re.compile(r":=|=>|(?<![=!<>:+*/%&|^-])=(?![=>~])|(?<!:):(?![:/=])")
TERM = re.compile(r"""[\x20\t]*(?:[rbuf]{0,2}("(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)|([A-Za-z_$][\w$.]*+(?![\w("'\[+/=-]))|([^\s"'`,;(){}\[\]<>]+))""", re.A)
PLUS = re.compile(r"[\x20\t]*[+](?:[\x20\t]*(?=[\"'`A-Za-z_$])|\s*(?=[\"'`]))")
# Forms without an operator, and a text that each needs.
OPTION = re.compile(r"""(?<![\w-])--?([A-Za-z][\w-]*+)[\x20\t]+(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|([^\s"'`<>|;&=:-][^\s"'`<>|;&]*+))""", re.A)
ELEMENT = re.compile(r"<([A-Za-z][\w.-]*+)(?:\s[^<>]*+)?>([^<>\n]++)</\1\s*>", re.A)
GROUP = re.compile(r"<[A-Za-z][^<>]*+>|\{[^{}]*+\}")
NAMES = re.compile(r"""(?<![\w-])["']?(?:key|name|id)["']?\s*[=:]\s*["']([^"'\n]*+)["']""", re.I)
VALUES = re.compile(r"""(?<![\w-])["']?value["']?\s*[=:]\s*["']([^"'\n]*+)["']""", re.I)
CALL = re.compile(r"""(?<!\w)(?:define|setenv|putenv|set|put|add|setProperty|env|header|addHeader|config)\s*\(\s*["']([^"'\n]++)["']\s*,\s*(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)')""")
SETTER = re.compile(r"""(?:set|with)_?([A-Za-z]\w*+)\s*\(\s*(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)')\s*\)""", re.A)
FORMS = ((OPTION, "-"), (ELEMENT, "</"), (CALL, "("), (SETTER, "("))
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
INNER = re.compile(r"(?i)[<>{}]|\$[({A-Za-z_]|%[({sd]")
BEGINNING = re.compile(r"(?i)^(?:your|my|the|insert|replace|enter|example|sample|dummy|change)[-_ ]")
PLACEHOLDER = re.compile(rf"(?i)^(?:x+|\*+|\.+|-+|0+|null|none|true|false|undefined|todo|n/?a)$|{BEGINNING.pattern[4:]}|{INNER.pattern[4:]}")

#: Weight of a word, or of two words in a row, of a target name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.7, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0, "signing key": 1.0, "encryption key": 1.0, "auth key": 1.0,
    "account key": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.5, "authorization": 0.7, "signature": 0.5, "salt": 0.5, "key": 0.4,
}
#: Words that turn a name into one about a secret.
ABOUT = frozenset("count length len size max min limit path file dir url uri type policy hint field label header prefix expiry expires ttl regex pattern format placeholder name id public".split())
THRESHOLD = 0.9


def name_score(name: str) -> float:
    """How sensitive a target name is, from 0 to 1."""
    parts = [w.lower() for w in WORDS.findall(name)]
    pairs = [f"{a} {b}" for a, b in zip(parts, parts[1:])]
    score = max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)
    return score - 0.8 if parts and parts[-1] in ABOUT else score


def _shape(counts: dict[str, int], length: int) -> float:
    bits = -sum(n / length * math.log2(n / length) for n in counts.values())
    kinds = sum(any(f(c) for c in counts) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in counts)
    return (0.3 if bits >= 3 else 0.0) + (0.2 if kinds >= 2 else -0.2) - (0.6 if " " in counts else 0.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: 0 for a plain one, less for placeholders and prose, more for mixed and random ones."""
    if len(value) < 6 or PLACEHOLDER.search(value):
        return -1.0
    return _shape(Counter(value), len(value))


class Value:
    """A literal, or values joined.  It is scored as :func:`literal_score` scores its whole text, but from what is known of its
    parts, so a name that grows by one literal a line costs the same at each."""

    __slots__ = ("counts", "length", "head", "last", "inner", "span", "parts", "told")
    HEAD = 16  # longer than any placeholder that is a word

    def __init__(self, value: str = "", start: int = 0, end: int = 0):
        self.counts, self.length, self.head, self.last = Counter(value), len(value), value[: self.HEAD], value[-1:]
        self.inner, self.span, self.parts, self.told = bool(INNER.search(value)), (start, end), (), False

    def plus(self, other: Value) -> Value:
        out = Value()
        out.counts, out.length = self.counts + other.counts, self.length + other.length
        out.head, out.last = (self.head + other.head)[: self.HEAD] if self.length < self.HEAD else self.head, other.last or self.last
        out.inner = self.inner or other.inner or bool(INNER.search(self.last + other.head[:1]))
        out.parts = (self, other)
        return out

    def score(self) -> float:
        if self.length < 6 or self.inner:
            return -1.0
        if self.length <= self.HEAD:
            placeholder = PLACEHOLDER.search(self.head)
        else:
            placeholder = BEGINNING.match(self.head) or len(one := {c.lower() for c in self.counts}) == 1 and one <= set("x*.-0")
        return -1.0 if placeholder else _shape(self.counts, self.length)

    def tell(self, found: set[tuple[int, int]]) -> None:
        """Adds the spans of the literals inside; each value is walked through once."""
        todo = [self]
        while todo:
            v = todo.pop()
            if not v.told:
                v.told = True
                todo += v.parts
                if not v.parts:
                    found.add(v.span)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, kinds as places in KINDS."""
    spans = []
    low = text.lower()
    if any(c in low for c in CUES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
QUOTED_CHARS = NAME_CHARS | {" "}


def _target(text: str, at: int) -> str | None:
    """The name that ends in front of ``at``: a bare or a quoted one, perhaps in brackets.  No name reaches over an operator, so
    each character is looked at once."""

    def blanks(i: int) -> int:
        while i > 0 and text[i - 1] in " \t":
            i -= 1
        return i

    end = blanks(at)
    if end > 0 and text[end - 1] in ")]":
        end = blanks(end - 1)
    if end > 0 and text[end - 1] in "\"'":
        start = end - 1
        while start > 0 and text[start - 1] in QUOTED_CHARS:
            start -= 1
        return text[start : end - 1] if 0 < start < end - 1 and text[start - 1] in "\"'" else None
    start = end
    while start > 0 and text[start - 1] in NAME_CHARS:
        start -= 1
    while start < end and not (text[start].isalpha() or text[start] in "_$"):
        start += 1
    return text[start:end] or None


def assignments(text: str):
    """(target name, terms as (value, start, end, kind)) of each assignment, in order; kind 1 is a quoted literal, 2 a name, 3 another bare value.

    A bare value is passed over as a whole; a quoted one may hold assignments of its own (connection strings).
    """
    op = OPERATOR.search(text)
    while op:
        resume = op.end()
        left = _target(text, op.start())
        terms, at = [], op.end()
        while left and (m := TERM.match(text, at)):
            if m.lastindex == 1:
                terms.append((m[1][1:-1], m.start(1) + 1, m.end(1) - 1, 1))
            else:
                terms.append((m[m.lastindex], m.start(m.lastindex), m.end(m.lastindex), m.lastindex))
                resume = m.end()
            at = m.end()
            if not (plus := PLUS.match(text, at)):
                break
            at = plus.end()
        if terms:
            yield left, terms
        op = OPERATOR.search(text, resume)


def pairs(text: str):
    """(span of the target name, value, span of the value) of options, elements, named attributes, calls and setters."""
    for form, need in FORMS:
        if need in text:
            for m in form.finditer(text):
                yield m.span(1), m[m.lastindex], m.span(m.lastindex)
    if "value" in text or "VALUE" in text or "Value" in text:
        for group in GROUP.finditer(text):
            name, value = NAMES.search(group[0]), VALUES.search(group[0])
            if name and value:
                at = group.start()
                yield (at + name.start(1), at + name.end(1)), value[1], (at + value.start(1), at + value.end(1))


def literal_spans(text: str) -> set[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name, directly or through constants.

    Names are resolved after the whole text is read: a name stands for what it was given last, or if that comes later, first.
    One that has nothing, or only itself in a circle, is a bare value like any other.  Terms that are no constants have no
    known text: they are scored alone, and the others are joined without them.
    """
    found: set[tuple[int, int]] = set()
    named: set[tuple[int, int]] = set()  # literals that are names of others
    for name, value, span in pairs(text):
        named.add(name)
        weight = name_score(text[slice(*name)])
        if weight > 0 and weight + literal_score(value) >= THRESHOLD:
            found.add(span)
    if "=" not in text and ":" not in text:
        return found
    every = list(assignments(text))
    given: dict[str, list[int]] = {}
    for i, (target, _) in enumerate(every):
        given.setdefault(target, []).append(i)

    def source(i: int, name: str) -> int | None:
        """The assignment that the name stands for in assignment ``i``."""
        places = given.get(name)
        if places is None:
            return None
        k = bisect_left(places, i)
        if k:
            return places[k - 1]
        return places[0] if places[0] != i else None

    values: dict[int, Value | None] = {}  # None where nothing is known
    terms_of: dict[int, list[Value]] = {}
    for first in range(len(every)):
        todo = [first]
        open_: set[int] = set()
        while todo:
            i = todo[-1]
            if i in values:
                todo.pop()
                continue
            sources = [source(i, t[0]) if t[3] == 2 else None for t in every[i][1]]
            missing = [j for j in sources if j is not None and j not in values and j not in open_]
            if i not in open_:
                open_.add(i)
                if missing:
                    todo += missing
                    continue
            terms = every[i][1]
            known: list[Value] = []
            alone: list[Value] = []
            for (value, start, end, kind), j in zip(terms, sources):
                if (constant := values.get(j) if j is not None else None) is not None:
                    known.append(constant)
                elif kind == 1 or len(terms) == 1:
                    known.append(Value(value, start, end))
                else:
                    alone.append(Value(value, start, end))
            joined = None
            for v in known:
                joined = v if joined is None else joined.plus(v)
            values[i] = joined
            terms_of[i] = [*alone, *known, *([joined] if len(known) > 1 else [])]
            todo.pop()
    for i, (target, _) in enumerate(every):
        weight = name_score(target)
        if weight > 0:
            for v in terms_of[i]:
                if weight + v.score() >= THRESHOLD:
                    v.tell(found)
    return found - named


def find_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) of a text in order; a literal inside a base span is not told again."""
    text = text or ""
    base = base_spans(text)
    out, reach = [], -1  # base spans that begin before a literal: the furthest end so far
    for start, kind, end in sorted([*base, *((s, 3, e) for s, e in literal_spans(text))]):
        if kind < 3:
            reach = max(reach, end)
        elif end <= reach:
            continue
        out.append((start, kind, end))
    return out


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: doc_id and its spans in order (offsets in code points, end exclusive).

    A null text is an empty one and has no spans; a null id stays null; rows that repeat give the same row again;
    an empty table gives an empty table; other columns are not read.  A text is one row and is scanned whole, in time
    that grows with its length.
    """
    narrow = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return map_rows(narrow, _scanner, "doc_id long, spans array<struct<start:long,kind:int,end:long>>")


def _scanner():
    return lambda doc_id, text: (doc_id, [{"start": s, "kind": k, "end": e} for s, k, e in find_secrets(text)])
