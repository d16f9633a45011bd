"""Chat formatting by compiled templates.

A template is text with ``{{ expression }}`` and ``{% statement %}`` marks.  It is cut into marks, parsed into a syntax tree, folded
(constant expressions, branches that cannot be taken, neighbouring texts) and turned into Python closures.  The language
reaches nothing but the fields of a message and the given constants: no attributes of objects, no calls, no loop but the one over the messages.

    {{ 'a' + name }}  {{ m.text | escape }}                       strings, constants, fields, filters, ==, !=, in, +, and, or, not
    {% if m.role == 'user' %} … {% elif … %} … {% else %} … {% endif %}
    {% for m in messages %} … {% endfor %}                        m.role, m.text, loop.index0, loop.first, loop.last
    {% generation %} … {% endgeneration %}                        what is inside is under the loss mask

Messages are read one after the other and pieces are given out as they come, so a conversation is never held as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import small_batches

#: (kind of turn, text before it, text behind it); a turn of another role is written with its role.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT]", "</s>")}
OTHER = ("[TURN]", "[SAYS]", "[/TURN]")
BEGIN = "<s>"
#: What texts may not hold as it is.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[TURN]", "[SAYS]", "[/TURN]")
TEMPLATE = (
    "{{ begin }}{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '[INST]' + ' ' }}{{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[OUT]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% else %}[TURN]{{ m.role | escape }}[SAYS]{{ m.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}"
)
#: A piece of a formatted conversation is given out when it has this many characters.
PIECE = 1 << 20


class TemplateError(ValueError):
    """A template that the language does not have."""


class Escapes:
    """Reversible escapes: a control string gets a backslash behind its first character, one that has backslashes there gets one more."""

    def __init__(self, controls: Iterable[str] = CONTROLS):
        controls = sorted(set(controls), key=len, reverse=True)
        firsts = {c[0] for c in controls}
        if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in controls):
            raise TemplateError("a control string needs two characters, no backslash, and no first character of another inside")
        rest = "|".join(f"{re.escape(c[0])}(?={{slashes}}{re.escape(c[1:])})" for c in controls)
        self._escape = re.compile(rest.replace("{slashes}", r"\\*"))
        self._restore = re.compile("(" + rest.replace("{slashes}", r"\\+") + r")\\")

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: m.group() + "\\", text)

    def restore(self, text: str) -> str:
        return self._restore.sub(r"\1", text)


# Syntax trees


@dataclass(frozen=True)
class Constant:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Apply:
    """An operator or a filter over its arguments."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Output:
    of: object


@dataclass(frozen=True)
class Choice:
    """(condition, body) of each branch; the condition of ``else`` is true."""

    branches: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


MARK = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))")
WORDS = {"and", "or", "not", "in", "true", "false"}
LITERALS = {"\\n": "\n", "\\t": "\t", "\\r": "\r"}


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise TemplateError(f"not understood: {text[at:]!r}")
        kind = ("string", "number", "name", "sign")[m.lastindex - 1]
        word = m.group(m.lastindex)
        out.append(("word" if word in WORDS and kind == "name" else kind, word))
        at = m.end()
    return out


class _Expression:
    """Reads an expression by descent: or, and, not, comparison, sum, filters, atom."""

    def __init__(self, text: str):
        self.tokens, self.at = _tokens(text), 0

    def whole(self):
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"not expected: {self.tokens[self.at][1]!r}")
        return out

    def take(self, *words: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "word") and self.tokens[self.at][1] in words:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, part: Callable, *words: str):
        out = part()
        while word := self.take(*words):
            out = Apply(word, (out, part()))
        return out

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negated, "and")

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        return self.chain(self.total, "==", "!=", "in")

    def total(self):
        return self.chain(self.filtered, "+")

    def filtered(self):
        out = self.atom()
        while self.take("|"):
            kind, word = self.next()
            if kind != "name" or word not in FILTERS:
                raise TemplateError(f"no such filter: {word!r}")
            out = Apply(word, (out,))
        return out

    def next(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def atom(self):
        if self.take("("):
            out = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket stays open")
            return out
        kind, word = self.next()
        if kind == "string":
            return Constant(re.sub(r"\\(.)", lambda m: LITERALS.get(m.group(), m.group(1)), word[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Constant(int(word))
        if word in ("true", "false"):
            return Constant(word == "true")
        if kind != "name":
            raise TemplateError(f"not expected: {word!r}")
        if self.take("."):
            kind, name = self.next()
            if kind != "name":
                raise TemplateError(f"no field: {name!r}")
            return Field(word, name)
        return Name(word)


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    marks: list[tuple[str, str]] = []
    at = 0
    for m in MARK.finditer(template):
        marks += [("text", template[at : m.start()])] if m.start() > at else []
        marks.append(("output", m.group(1)) if m.group(1) is not None else ("statement", m.group(2).strip()))
        at = m.end()
    marks += [("text", template[at:])] if at < len(template) else []
    place = 0

    def body(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal place
        out = []
        while place < len(marks):
            kind, text = marks[place]
            place += 1
            if kind == "text":
                out.append(Output(Constant(text)))
            elif kind == "output":
                out.append(Output(_Expression(text).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return tuple(out), text
                out.append(statement(word, rest))
        if ends:
            raise TemplateError(f"missing: {ends[-1]}")
        return tuple(out), ""

    def statement(word: str, rest: str):
        if word == "if":
            branches, condition = [], _Expression(rest).whole()
            while True:
                inside, end = body(("elif", "else", "endif"))
                branches.append((condition, inside))
                if end == "endif":
                    return Choice(tuple(branches))
                if end == "else":
                    branches.append((Constant(True), body(("endif",))[0]))
                    return Choice(tuple(branches))
                condition = _Expression(end[4:]).whole()
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+messages\s*", rest)
            if not m or m.group(1) in ("loop", "messages"):
                raise TemplateError(f"only messages can be looped over: {rest!r}")
            return Loop(m.group(1), body(("endfor",))[0])
        if word == "generation":
            return Generation(body(("endgeneration",))[0])
        raise TemplateError(f"no such statement: {word!r}")

    return body(())[0]


# Folding and closures

#: Filters of a string, beside ``escape``, which depends on the control strings.
FILTERS: dict[str, Callable | None] = {"trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "escape": None}
OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: _text(a) in _text(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "not": lambda a: not a,
}


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value)


def _apply(what: str, values: list, escapes: Escapes) -> object:
    if what in FILTERS:
        return (escapes.escape if what == "escape" else FILTERS[what])(_text(values[0]))
    return OPERATORS[what](*values)


def fold(node, constants: dict, escapes: Escapes):
    """The node with everything worked out that does not depend on a message; a tuple of nodes loses branches that are never taken."""
    again = lambda x: fold(x, constants, escapes)
    if isinstance(node, tuple):
        out: list = []
        for part in map(again, node):
            for x in part if isinstance(part, tuple) else (part,):
                if isinstance(x, Output) and isinstance(x.of, Constant):
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].of, Constant):
                        x = Output(Constant(_text(out.pop().of.value) + _text(x.of.value)))
                    if not _text(x.of.value):
                        continue
                out.append(x)
        return tuple(out)
    if isinstance(node, Name):
        return Constant(constants[node.name]) if node.name in constants else node
    if isinstance(node, Apply):
        args = tuple(map(again, node.args))
        if node.what in ("and", "or"):
            left, right = args
            if isinstance(left, Constant):
                return right if bool(left.value) == (node.what == "and") else left
            return Apply(node.what, args)
        if all(isinstance(a, Constant) for a in args):
            return Constant(_apply(node.what, [a.value for a in args], escapes))
        return Apply(node.what, args)
    if isinstance(node, Output):
        return Output(again(node.of))
    if isinstance(node, Choice):
        left = []
        for condition, inside in node.branches:
            condition = again(condition)
            if isinstance(condition, Constant) and not condition.value:
                continue
            left.append((condition, again(inside)))
            if isinstance(condition, Constant):
                break
        if left and isinstance(left[0][0], Constant):
            return left[0][1]
        return Choice(tuple(left)) if left else ()
    if isinstance(node, Loop):
        return Loop(node.name, again(node.body))
    if isinstance(node, Generation):
        inside = again(node.body)
        return Generation(inside) if inside else ()
    return node


FIELDS = ("role", "text")
LOOP = ("index0", "first", "last")


def _value(node, names: tuple[str, ...], escapes: Escapes) -> Callable[[dict], object]:
    """The closure of an expression; it reads the message and loop of the names it may see."""
    if isinstance(node, Constant):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        raise TemplateError(f"no such name: {node.name!r}")
    if isinstance(node, Field):
        known = LOOP if node.of == "loop" and names else FIELDS if node.of in names else ()
        if node.name not in known:
            raise TemplateError(f"no such field: {node.of}.{node.name}")
        return lambda env, of=node.of, name=node.name: env[of][name]
    args = [_value(a, names, escapes) for a in node.args]
    if node.what == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.what == "or":
        return lambda env: args[0](env) or args[1](env)
    if len(args) == 1:
        return lambda env, f=(lambda v: _apply(node.what, [v], escapes)), a=args[0]: f(a(env))
    return lambda env, f=OPERATORS[node.what], a=args[0], b=args[1]: f(a(env), b(env))


def _run(nodes: tuple, names: tuple[str, ...], inside: bool, escapes: Escapes) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """The closure of a body: gives out (text, under the mask) as it goes."""
    steps = [_step(n, names, inside, escapes) for n in nodes]

    def run(env):
        for step in steps:
            yield from step(env)

    return run


def _step(node, names: tuple[str, ...], inside: bool, escapes: Escapes) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    if isinstance(node, Output):
        value = _value(node.of, names, escapes)

        def output(env):
            yield _text(value(env)), inside

        return output
    if isinstance(node, Choice):
        branches = [(_value(c, names, escapes), _run(b, names, inside, escapes)) for c, b in node.branches]

        def choice(env):
            for condition, body in branches:
                if condition(env):
                    yield from body(env)
                    return

        return choice
    if isinstance(node, Generation):
        if inside:
            raise TemplateError("a generation inside a generation")
        return _run(node.body, names, True, escapes)
    if names:
        raise TemplateError("a loop inside a loop")
    body = _run(node.body, (node.name,), inside, escapes)

    def loop(env):
        index, messages = 0, iter(env["messages"])
        current = next(messages, None)
        while current is not None:
            following = next(messages, None)
            yield from body({**env, node.name: current, "loop": {"index0": index, "first": index == 0, "last": following is None}})
            current, index = following, index + 1

    return loop


def compile_template(template: str = TEMPLATE, controls: Iterable[str] = CONTROLS, **constants: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """The renderer of a template: messages (role, text) in, (text, under the loss mask) out, one after the other."""
    escapes = Escapes(controls)
    tree = fold(parse(template), {"begin": BEGIN, **constants}, escapes)
    if sum(isinstance(n, Loop) for n in _walk(tree)) > 1:
        raise TemplateError("messages can be read once only")
    run = _run(tree, (), False, escapes)
    return lambda messages: run({"messages": messages})


def _walk(node) -> Iterator:
    yield node
    for x in node if isinstance(node, tuple) else [getattr(node, "body", ()), *[b for _, b in getattr(node, "branches", ())]]:
        yield from _walk(x) if isinstance(x, tuple) or hasattr(x, "__dataclass_fields__") else ()


# Over tables


def _conversations(batches) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """(conv_id, its messages) of rows (conv_id, role, text) that are in order; messages have to be read before the next is asked for."""
    rows = ((i, {"role": r or "", "text": t or ""}) for b in batches for i, r, t in zip(*(b.column(k).to_pylist() for k in range(3))))
    held = next(rows, None)

    def messages(conv):
        nonlocal held
        while held is not None and held[0] == conv:
            yield held[1]
            held = next(rows, None)

    while held is not None:
        conv = held[0]
        yield conv, messages(conv)


FORMATTED = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
FORMATTED_DDL = "conv_id long, piece long, last boolean, text string, spans array<struct<start:bigint,end:bigint>>"


def formatted(conversations: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE, controls: Iterable[str] = CONTROLS) -> DataFrame:
    """conv_id, piece, last, text and spans of each conversation: its formatted text, and where that is under the loss mask.

    A text longer than ``piece`` characters comes in several rows, numbered from 0, cut between outputs of the template; spans
    are code points in their own piece.  The rows of a task are in order, so ``read_back`` can follow without a shuffle.
    Messages are ordered by turn, those that share one by role and text; null turns come first; null roles and texts are
    empty; rows that repeat are messages like others; rows without a conv_id are one conversation; an empty table
    gives an empty table; other columns are not read.  Messages are dealt out and sorted by conversation and then
    stream through: however long a conversation is, a piece of it and its longest message are held.
    """
    compile_template(template, controls)  # errors in the template come at once
    rows = conversations.select(*[F.col(f"`{c}`").cast(k).alias(n) for c, k, n in ((conv_id, "long", "conv_id"), (turn, "long", "turn"), (role, "string", "role"), (text, "string", "text"))])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    small_batches(rows.sparkSession)

    def run(batches):
        render = compile_template(template, controls)
        out: list[dict] = []
        size = 0
        for conv, messages in _conversations(batches):
            number, length, parts, spans = 0, 0, [], []

            def row(last):
                return {"conv_id": conv, "piece": number, "last": last, "text": "".join(parts), "spans": spans}  # noqa: B023

            for part, masked in render(messages):
                if length >= piece:
                    out.append(row(False))
                    size += length
                    number, length, parts, spans = number + 1, 0, [], []
                if masked:
                    spans.append({"start": length, "end": length + len(part)})
                parts.append(part)
                length += len(part)
                if size >= PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema=FORMATTED)
                    out, size = [], 0
            for _ in messages:  # a template that reads no messages
                pass
            out.append(row(True))
            size += length + 100
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=FORMATTED)

    return rows.mapInArrow(run, FORMATTED_DDL)


class Unfinished(ValueError):
    """A turn does not end in the text at hand."""


def _find(text: str, mark: str, at: int) -> int:
    found = text.find(mark, at)
    if found < 0:
        raise Unfinished(f"no {mark!r} behind {at}")
    return found


def turns(text: str, escapes: Escapes) -> Iterator[tuple[str, str, tuple[int, int], int]]:
    """(role, message, place of the escaped message, end of the turn) of each turn of a text that the default template made."""
    at = len(BEGIN) if text.startswith(BEGIN) else 0
    while at < len(text):
        role = next((r for r, (before, _) in MARKS.items() if text.startswith(before, at)), None)
        if role is not None:
            before, behind = MARKS[role]
            start = at + len(before)
            # A mark is found by its control string, which no message holds; a blank of the mark stands before that.
            end = _find(text, behind.lstrip(" "), start) - (len(behind) - len(behind.lstrip(" ")))
        else:
            opened, said, behind = OTHER
            middle = _find(text, said, _find(text[: at + len(opened)], opened, at))
            role, start = escapes.restore(text[at + len(opened) : middle]), middle + len(said)
            end = _find(text, behind, start)
        at = end + len(behind)
        yield role, escapes.restore(text[start:end]), (start, end), at


class _Reader:
    """Reads the pieces of one conversation; what a piece leaves unfinished waits for the next one."""

    def __init__(self, escapes: Escapes):
        self.escapes = escapes
        self.said, self.lost = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.pieces = 0
        self.rest, self.masked = "", set()

    def feed(self, text: str, spans: list[dict], last: bool) -> None:
        before = len(self.rest)
        self.masked |= {(before + s["start"], before + s["end"]) for s in spans}
        self.chars += len(text)
        self.pieces += 1
        text, done = self.rest + text, 0
        try:
            for role, message, (start, end), done in turns(text, self.escapes):
                self.said.update(f"{role}\n{message}\n".encode())
                self.n_turns += 1
                if (start, end) in self.masked:
                    self.masked.remove((start, end))
                    self.lost.update(message.encode())
                    self.loss_chars += len(message)
        except Unfinished:
            if last:
                raise
        self.rest, self.masked = text[done:], {(a - done, b - done) for a, b in self.masked}
        if last and self.masked:
            raise ValueError("the mask covers more than whole messages")

    def result(self, conv: int | None) -> dict:
        return dict(zip(READ.names, (conv, self.n_turns, self.said.hexdigest(), self.loss_chars, self.lost.hexdigest(), self.chars)))


READ_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(pieces: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read from the rows of ``formatted`` as they come.

    Made for the default template, whose marks tell where each message is.  A mask that covers anything but whole
    messages, and pieces that are not in order, are errors.  A piece is read with what the one before left unfinished.
    """

    def run(batches):
        escapes, reader = Escapes(), None
        for batch in batches:
            out = []
            for conv, number, last, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                reader = _Reader(escapes) if number == 0 else reader
                if reader is None or reader.pieces != number:
                    raise ValueError("pieces are not in order")
                reader.feed(text, spans, last)
                if last:
                    out.append(reader.result(conv))
                    reader = None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=READ)

    return pieces.mapInArrow(run, READ_DDL)


def oracle(own_rows: str) -> str:
    """DuckDB: what ``read_back`` finds in the formatted ``conversations`` and ``own_rows``; an escape is one more character."""
    control = "(" + "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS) + ")"
    chars = lambda x: f"length({x}) + len(regexp_extract_all({x}, '{control}'))"
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)} + {chars('text')}" for r, (a, b) in MARKS.items())
    return rf"""WITH rows_ AS (SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {own_rows}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  ({len(BEGIN)} + sum(CASE role {marks} ELSE {sum(map(len, OTHER))} + {chars('role')} + {chars('text')} END))::BIGINT AS formatted_chars
FROM rows_ GROUP BY conv_id"""
