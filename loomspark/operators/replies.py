"""Parsing and judging of model replies."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions.text import strip
from loomspark.plans.prefix import neighbour

CALL = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.StringType()), T.StructField("arguments", T.StringType())])
REPLY = T.StructType([T.StructField("content", T.StringType()), T.StructField("calls", T.ArrayType(CALL)), T.StructField("error", T.StringType())])
INCOMPLETE = "incomplete tool call"


def split_reasoning(
    df: DataFrame, *, text: str = "text", start: str = "<think>", end: str = "</think>", forced_open: bool = False, in_content: bool = False
) -> DataFrame:
    """Add ``reasoning`` and ``content``.

    A reply that starts with ``start`` is reasoning up to ``end``; without ``end`` all of it is.  ``forced_open`` treats every
    reply as started, ``in_content`` keeps the reasoning in the content between its marks.
    """
    c = F.col(text)
    opened = F.lit(True) if forced_open else F.startswith(c, F.lit(start))
    body = c if forced_open else F.substr(c, F.lit(len(start) + 1))
    at = F.locate(end, body)
    closed = at > 0
    inner = F.nullif(strip(F.when(closed, F.substr(body, F.lit(1), at - 1)).otherwise(body)), F.lit(""))
    rest = F.when(closed, F.regexp_replace(F.substr(body, at + len(end)), r"^\s+", "")).otherwise("")
    if in_content:
        kept = F.concat(F.when(inner.isNull(), "").otherwise(F.concat(F.lit(start), inner, F.when(closed, end).otherwise(""))), rest)
        return df.withColumn("reasoning", F.lit(None).cast("string")).withColumn("content", F.when(opened, kept).otherwise(c))
    return df.withColumn("reasoning", F.when(opened, inner)).withColumn("content", F.when(opened, rest).otherwise(c))


# ------------------------------------------------------------------ tool calls

_CALLS_DDL = "array<struct<name:string,id:string,arguments:string>>"


def _result(content: Column, calls: Column, error: Column) -> Column:
    return F.struct(content.alias("content"), F.coalesce(calls, F.array().cast(_CALLS_DDL)).alias("calls"), error.alias("error"))


def _generic(c: Column) -> Column:
    """A JSON object with ``tool_calls``, ``tool_call`` or ``response``."""
    doc = F.from_json(c, f"struct<tool_calls:{_CALLS_DDL},tool_call:struct<name:string,id:string,arguments:string>,response:string>")
    calls = F.when(doc["tool_calls"].isNotNull(), doc["tool_calls"]).when(doc["tool_call"].isNotNull(), F.array(doc["tool_call"]))
    nothing = doc.isNull() | (calls.isNull() & doc["response"].isNull())
    return _result(
        F.when(calls.isNull(), doc["response"]).otherwise(""), calls, F.when(nothing, "expected tool_call, tool_calls or response in JSON")
    )


def _prefixed(prefix: str, keep: int = 0):
    """Text, a prefix, then a JSON array of calls; ``keep`` characters of the prefix belong to the JSON."""

    def parse(c: Column) -> Column:
        at = F.locate(prefix, c)
        found = at > 0
        tail = F.trim(F.substr(c, at + len(prefix) - keep))
        calls = F.from_json(F.when(found, tail), _CALLS_DDL)
        return _result(
            F.when(found, F.substr(c, F.lit(1), at - 1)).otherwise(c), F.when(found, calls),
            F.when(found & (calls.isNull() | F.exists(calls, lambda x: x["name"].isNull())), "incomplete tool call array"),
        )

    return parse


def _action_block(c: Column) -> Column:
    """Thoughts, then an action block with a JSON array of tool names and parameters, or a response block."""
    body = F.regexp_replace(c, r"(?s)^<\|START_THINKING\|>.*?<\|END_THINKING\|>\s*", "")
    act = F.regexp_extract(body, r"(?s)<\|START_ACTION\|>(.*?)<\|END_ACTION\|>", 1)
    has_act = F.contains(body, F.lit("<|START_ACTION|>"))
    rows = F.from_json(F.nullif(act, F.lit("")), "array<struct<tool_name:string,tool_call_id:string,parameters:string>>")
    calls = F.transform(rows, lambda r: F.struct(F.coalesce(r["tool_name"], F.lit("")).alias("name"), F.coalesce(r["tool_call_id"], F.lit("")).alias("id"), F.coalesce(r["parameters"], F.lit("")).alias("arguments")))
    has_resp = F.contains(body, F.lit("<|START_RESPONSE|>"))
    resp = F.regexp_extract(body, r"(?s)<\|START_RESPONSE\|>(.*?)(?:<\|END_RESPONSE\|>|$)", 1)
    before = F.regexp_extract(body, r"(?s)^(.*?)<\|START_(?:ACTION|RESPONSE)\|>", 1)
    open_resp = has_resp & ~F.contains(body, F.lit("<|END_RESPONSE|>"))
    return _result(
        F.when(has_act, before).when(has_resp, F.concat(before, resp)).otherwise(body),
        F.when(has_act, calls),
        F.when(has_act & calls.isNull(), INCOMPLETE).when(~has_act & open_resp, "response is not closed"),
    )


@dataclass(frozen=True)
class Scan:
    """How calls with free-standing JSON arguments are found: patterns of one format."""

    call: str  # names the function in its first non-empty group
    close: str  # behind the arguments
    block: str = ""  # opens the block calls live in
    block_close: str = ""
    at_start: bool = False  # only at the start of the reply
    first: str = ""  # pattern of a call at the very start
    python: bool = False  # raw code may stand in for JSON
    named: bool = False  # JSON holds the name beside the arguments
    tag: str = ""  # raw code behind this mark is a python call


# Formats: fixed patterns.
_TAGS = "tool_call|function_call|tool|tools|response|json|xml|JSON"
SCANS = {
    "llama3": Scan(
        call=r'\s*\{\s*(?:"type"\s*:\s*"function"\s*,\s*)?"name"\s*:\s*"([^"]+)"\s*,\s*"parameters"\s*: ', close=r"\}\s*", at_start=True
    ),
    "hermes": Scan(
        call=rf'(?:(?:(?P<fence>```(?:xml|json)?\n\s*)?(?P<tag><(?:{_TAGS})>)?(?P<json>\s*\{{\s*"name"))|<function=([^>]+)>|<function name="([^"]+)">)',
        close="", named=True,
    ),
    "deepseek-r1": Scan(
        block=r"(?:<｜tool▁calls▁begin｜>|<｜tool_calls_begin｜>|<｜tool calls begin｜>|<｜tool\\_calls\\_begin｜>|<｜tool▁calls｜>)",
        call="(?:<｜tool▁call▁begin｜>)?function<｜tool▁sep｜>([^\n]+)\n```json\n", close=r"```\s*<｜tool▁call▁end｜>", block_close="<｜tool▁calls▁end｜>",
    ),
    "functionary-3.1": Scan(call=r"<function=(\w+)>", close="</function>", tag="<|python_tag|>"),
    "functionary-3.2": Scan(call=r">>>(\w+\n(?=\{)|python\n|all\n)", first=r"(\w+\n(?=\{)|python\n|all\n)", close=r"\s*", python=True),
}


def _json_at(text: str, pos: int):
    """A JSON value and where it ends."""
    return json.JSONDecoder().raw_decode(text, pos)


def _dump(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _scan(text: str, how: Scan) -> tuple[str, list, str | None]:
    """Content, calls and error of one reply."""
    content, calls, pos = "", [], 0
    if how.block:
        hit = re.search(how.block, text)
        if not hit:
            return text, [], None
        content, pos = text[: hit.start()], hit.end()
    looking = True
    while looking:
        anchored = how.at_start or (how.first and pos == 0 and not calls)
        pattern = re.compile(how.first if how.first and anchored else how.call)
        hit = pattern.match(text, pos) if anchored else pattern.search(text, pos)
        if how.at_start and calls:
            hit = None
        if how.first and hit is None and not calls:
            hit = re.compile(how.call).search(text, pos)
        if hit is None:
            break
        name = next((g for g in hit.groups()[::-1] if g and not g.strip().startswith(("{", "```", "<"))), "").strip()
        if how.first and name == "all" and hit.start() == 0:
            content, pos = content, hit.end()
            nxt = re.compile(how.call).search(text, pos)
            content += text[pos : nxt.start() if nxt else len(text)]
            pos = nxt.start() if nxt else len(text)
            if nxt is None:
                return content, calls, None
            continue
        content += text[pos : hit.start()]
        start = hit.start("json") if how.named and hit.group("json") else hit.end()
        while start < len(text) and text[start].isspace():
            start += 1
        if how.python and name == "python" and text[start : start + 1] != "{":
            calls.append((name, "", _dump({"code": text[start:]})))
            return content, calls, None
        try:
            value, pos = _json_at(text, start)
        except ValueError:
            return content, calls, INCOMPLETE
        if how.named and hit.group("json"):
            if not isinstance(value, dict) or "arguments" not in value:
                return content, calls, INCOMPLETE
            calls.append((str(value["name"]), str(value.get("id", "")), _dump(value["arguments"])))
            tail = [f"</{hit.group('tag')[1:]}" if hit.group("tag") else "", "```" if hit.group("fence") else ""]
        else:
            calls.append((name, "", _dump(value)))
            tail = ["</function>"] if how.named else []
        if how.named:
            for lit in tail:
                pos += len(text[pos:]) - len(text[pos:].lstrip())
                if lit and not text.startswith(lit, pos):
                    return content, calls, INCOMPLETE
                pos += len(lit)
            pos += len(text[pos:]) - len(text[pos:].lstrip())
            looking = False
        else:
            shut = re.compile(how.close).match(text, pos) or re.compile(r"\s*" + how.close).match(text, pos)
            if not shut:
                return content, calls, INCOMPLETE
            pos = shut.end()
    if how.block_close:
        shut = re.compile(r"\s*" + how.block_close).match(text, pos)
        if not shut:
            return content, calls, INCOMPLETE
        pos = shut.end()
    rest = text[pos:].lstrip() if calls or how.block else text[pos:]
    if how.tag and how.tag in rest:
        before, code = rest.split(how.tag, 1)
        return content + before, [*calls, ("python", "", _dump({"code": code}))], None
    return content + rest, calls, None


def _scanner(how: Scan):
    @F.pandas_udf(REPLY)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [_scan(t or "", how) for t in texts]
        calls = [[{"name": n, "id": i, "arguments": a} for n, i, a in r[1]] for r in rows]
        return pd.DataFrame({"content": [r[0] for r in rows], "calls": calls, "error": [r[2] for r in rows]})

    return scan


@F.pandas_udf(REPLY)
def _builtin_call(texts: pd.Series) -> pd.DataFrame:
    """``<|python_tag|>name.call(arg=json, …)``."""
    out = []
    for text in texts:
        head = re.search(r"<\|python_tag\|>\s*(\w+)\s*\.\s*call\(", text or "")
        if not head:
            out.append(_scan(text or "", SCANS["llama3"]))
            continue
        args, pos, error = {}, head.end(), None
        while m := re.compile(r"\s*(\w+)\s*=\s*").match(text, pos):
            try:
                args[m.group(1)], pos = _json_at(text, m.end())
            except ValueError:
                error = INCOMPLETE
                break
            sep = re.compile(r"\s*,").match(text, pos)
            if not sep:
                break
            pos = sep.end()
        if error is None and not re.compile(r"\s*\)").match(text, pos):
            error = INCOMPLETE
        out.append((text[: head.start()], [] if error else [(head.group(1), "", _dump(args))], error))
    calls = [[{"name": n, "id": i, "arguments": a} for n, i, a in r[1]] for r in out]
    return pd.DataFrame({"content": [r[0] for r in out], "calls": calls, "error": [r[2] for r in out]})


FORMATS = ("generic", "mistral-nemo", "firefunction-v2", "command-r7b", "llama3-builtin", *SCANS)


def extract_tool_calls(df: DataFrame, fmt: str, *, text: str = "text") -> DataFrame:
    """Add ``content``, ``calls`` (name, id, arguments as JSON) and ``error`` of replies in one format."""
    c = F.col(text)
    if fmt == "generic":
        reply = _generic(c)
    elif fmt == "mistral-nemo":
        reply = _prefixed("[TOOL_CALLS]")(c)
    elif fmt == "firefunction-v2":
        reply = _prefixed(" functools[", keep=1)(c)
    elif fmt == "command-r7b":
        reply = _action_block(c)
    elif fmt == "llama3-builtin":
        reply = _builtin_call(c)
    else:
        reply = _scanner(SCANS[fmt])(c)
    return df.withColumn("__r", reply).select(*df.columns, "__r.content", "__r.calls", "__r.error")


def explode_calls(df: DataFrame, *keys: str) -> DataFrame:
    """One row per call."""
    return df.select(*keys, F.posexplode("calls").alias("call_no", "c")).select(*keys, "call_no", "c.name", "c.id", "c.arguments")


# ------------------------------------------------------------------ stops, tails, deltas


def partial_stop(text, stops: Sequence[str]) -> Column:
    """Where an unfinished stop word begins at the end of the text (0-based), or null."""
    c = F.col(text) if isinstance(text, str) else text
    found = []
    for stop in stops:
        at = F.when(F.lit(False), F.lit(0))
        for n in range(len(stop), 0, -1):
            at = at.when(F.endswith(c, F.lit(stop[:n])), F.length(c) - n)
        found.append(at)
    return F.least(*found) if len(found) > 1 else found[0]


def utf8_cut(data) -> Column:
    """Length of the bytes without a character cut off at the end."""
    b = F.col(data) if isinstance(data, str) else data
    n = F.octet_length(b)
    byte = lambda i: F.conv(F.hex(F.substr(b, n - (i - 1), F.lit(1))), 16, 10).cast("int")
    starts = ((0xE0, 0xC0, 2), (0xF0, 0xE0, 3), (0xF8, 0xF0, 4))
    out = F.when(n == 0, 0)
    for i in range(1, 5):
        for mask, lead, width in starts:
            if i < width:
                out = out.when((n >= i) & (byte(i).bitwiseAND(F.lit(mask)) == lead), n - i)
    return out.otherwise(n)


def utf8_tail_audit(df: DataFrame, *, data: str = "data", source: str = "source") -> DataFrame:
    """Per source: rows, rows with a cut character, bytes cut, rows invalid even so."""
    rows = df.select(source, F.octet_length(data).alias("n"), utf8_cut(data).alias("keep"), F.col(data).alias("d"))
    valid = F.is_valid_utf8(F.substr("d", F.lit(1), F.col("keep")).cast("string"))
    return rows.groupBy(source).agg(
        F.count("*").alias("rows"), F.count_if(F.col("keep") < F.col("n")).alias("cut"), F.sum(F.col("n") - F.col("keep")).alias("bytes_cut"), F.count_if(~valid).alias("invalid")
    )


def stop_reasons(df: DataFrame) -> DataFrame:
    """Add ``stop`` (none, eos, word, limit) and ``truncated`` to ``(has_next, hit_eos, stop_word, n_decoded, n_predict, n_past, n_ctx)``."""
    limit = (F.col("n_predict") > 0) & (F.col("n_decoded") >= F.col("n_predict"))
    full = F.col("n_past") >= F.col("n_ctx")
    stop = F.when(F.col("stop_word") != "", "word").when(F.col("hit_eos"), "eos").when(limit | full, "limit").otherwise("none")
    return df.withColumn("stop", stop).withColumn("truncated", full)


def stop_tally(df: DataFrame) -> DataFrame:
    return stop_reasons(df).groupBy("stop").agg(F.count("*").alias("n"), F.count_if("truncated").alias("truncated"))


def _diff(last: Column, cur: Column) -> tuple[Column, Column]:
    """New text, and whether the snapshots contradict each other."""
    grown = F.startswith(cur, last)
    shrunk = F.startswith(last, cur)
    return F.when(grown, F.substr(cur, F.length(last) + 1)).otherwise(""), ~grown & ~shrunk


def message_deltas(df: DataFrame) -> DataFrame:
    """Change between successive snapshots ``(reply_id, seq, content, reasoning, n_calls)``; fewer calls is an error."""
    rows = df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("content", "reasoning")})
    rows = neighbour(rows, ["reply_id"], "seq", ["content", "reasoning", "n_calls"], -1)
    prev = lambda c: F.coalesce(f"prev_{c}", F.lit(""))
    content, bad1 = _diff(prev("content"), F.col("content"))
    reasoning, bad2 = _diff(prev("reasoning"), F.col("reasoning"))
    fewer = F.col("n_calls") < F.coalesce("prev_n_calls", F.lit(0))
    error = F.when(fewer, "fewer tool calls than before").when(bad1 | bad2, "text does not continue the last snapshot")
    return rows.select(
        "reply_id", "seq", content.alias("content_delta"), reasoning.alias("reasoning_delta"), (F.col("n_calls") - F.coalesce("prev_n_calls", F.lit(0))).alias("new_calls"), error.alias("error")
    )


# ------------------------------------------------------------------ conformance

_FORMATS = {
    "uuid": r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "date": r"^\d{4}-(0[1-9]|1[0-2])-([0-2]\d|3[01])$",
    "time": r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{3})?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-([0-2]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{3})?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$",
}
_KINDS = {
    "string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    "object": ("OBJECT",), "array": ("ARRAY",),
}


def _no(cond: Column, reason: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(True)), F.lit(reason))


def _first(reasons: list[Column]) -> Column:
    return F.coalesce(*reasons, F.lit(None).cast("string")) if reasons else F.lit(None).cast("string")


def _why(v: Column, schema: dict | bool, path: str) -> Column:
    """The first rule of the schema a variant breaks, or null."""
    if schema is True or schema == {}:
        return F.lit(None).cast("string")
    for word in ("oneOf", "anyOf"):
        if word in schema:
            return _no(~_any([_why(v, s, path).isNull() for s in schema[word]]), f"{path}: no alternative fits")
    if "const" in schema or "enum" in schema:
        options = [schema["const"]] if "const" in schema else schema["enum"]
        return _no(~F.to_json(v).isin(*[_dump(o) for o in options]), f"{path}: not an allowed value")
    kind = schema.get("type")
    if isinstance(kind, list):
        return _no(~_any([_why(v, {**schema, "type": k}, path).isNull() for k in kind]), f"{path}: no alternative fits")
    if kind is None:
        kind = "object" if "properties" in schema else "array" if "items" in schema or "prefixItems" in schema else None
    out: list[Column] = []
    if kind:
        of = F.schema_of_variant(v)
        fits = F.lit(False)
        for k in _KINDS[kind]:
            fits = fits | of.startswith(k)
        out.append(_no(~fits, f"{path}: not {kind}"))
    if kind == "string":
        s = F.try_variant_get(v, "$", "string")
        if "pattern" in schema:
            out.append(_no(~s.rlike(schema["pattern"]), f"{path}: pattern"))
        if "minLength" in schema or "maxLength" in schema:
            n = F.char_length(s)
            out.append(_no((n < schema.get("minLength", 0)) | (n > schema.get("maxLength", 1 << 31 - 1)), f"{path}: length"))
        if schema.get("format") in _FORMATS:
            out.append(_no(~s.rlike(_FORMATS[schema["format"]]), f"{path}: format"))
    if kind in ("integer", "number"):
        x = F.try_variant_get(v, "$", "double")
        bounds = {"minimum": lambda b: x < b, "maximum": lambda b: x > b, "exclusiveMinimum": lambda b: x <= b, "exclusiveMaximum": lambda b: x >= b}
        out += [_no(bad(schema[w]), f"{path}: {w}") for w, bad in bounds.items() if w in schema]
    if kind == "object":
        fields = F.try_variant_get(v, "$", "map<string,variant>")
        props = schema.get("properties", {})
        for name in schema.get("required", []):
            out.append(_no(~F.map_contains_key(fields, name), f"{path}.{name}: missing"))
        for name, sub in props.items():
            there = F.map_contains_key(fields, name)
            out.append(F.when(F.coalesce(there, F.lit(False)), _why(F.element_at(fields, name), sub, f"{path}.{name}")))
        extra = schema.get("additionalProperties", False if props else True)
        if extra is False:
            allowed = F.array(*[F.lit(p) for p in props]).cast("array<string>")
            out.append(_no(F.size(F.array_except(F.map_keys(fields), allowed)) > 0, f"{path}: unknown property"))
        elif isinstance(extra, dict) and extra:
            rest = F.map_filter(fields, lambda k, _: ~k.isin(*props) if props else F.lit(True))
            out.append(_no(F.exists(F.map_values(rest), lambda x: _why(x, extra, f"{path}.*").isNotNull()), f"{path}: unfit property"))
    if kind == "array":
        items = F.try_variant_get(v, "$", "array<variant>")
        n = F.size(items)
        if "prefixItems" in schema:
            out.append(_no(n != len(schema["prefixItems"]), f"{path}: number of items"))
            out += [_why(F.get(items, F.lit(i)), sub, f"{path}[{i}]") for i, sub in enumerate(schema["prefixItems"])]
        else:
            if "minItems" in schema or "maxItems" in schema:
                out.append(_no((n < schema.get("minItems", 0)) | (n > schema.get("maxItems", 1 << 30)), f"{path}: number of items"))
            if isinstance(schema.get("items"), dict):
                out.append(_no(F.exists(items, lambda x: _why(x, schema["items"], f"{path}[]").isNotNull()), f"{path}: unfit item"))
    return _first(out)


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def conforms(df: DataFrame, schema: dict, *, text: str = "text") -> DataFrame:
    """Add ``ok`` and ``reason``: whether a JSON reply fits a schema, compiled to expressions."""
    v = F.try_parse_json(text)
    reason = F.when(v.isNull(), "not JSON").otherwise(_why(v, schema, "$"))
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def conformance_rate(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok"), F.avg(F.col("ok").cast("double")).alias("rate"))


def judge_tool_calls(df: DataFrame, *, name: str, argument: str, pattern: str | None = None) -> DataFrame:
    """Add ``success``: exactly one call, to ``name``, with ``argument`` whose value matches."""
    call = F.get("calls", F.lit(0))
    value = F.get_json_object(call["arguments"], f"$.{argument}")
    ok = (F.size("calls") == 1) & (call["name"] == name) & value.isNotNull()
    if pattern:
        ok = ok & value.rlike(pattern)
    return df.withColumn("success", F.coalesce(ok, F.lit(False)))


