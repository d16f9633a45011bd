"""Reply queries: messages of ``conversations`` wrapped in reply formats."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.operators import replies as R

KEY = "conv_id * 1000 + turn"


def base(t):
    k = (F.col("conv_id") * 1000 + F.col("turn")).alias("reply_id")
    return t.conversations.select(k, "conv_id", "turn", "role", "text")


def j(col):
    """A JSON string literal of a column."""
    body = F.to_json(F.struct(col.alias("x")))
    return F.substr(body, F.lit(6), F.length(body) - 6)


@query(
    "r1_split_reasoning",
    rf"""WITH r AS (SELECT {KEY} AS reply_id, turn % 3 AS k, text, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM conversations)
SELECT reply_id, CASE k WHEN 0 THEN md5(nullif(s, '')) WHEN 1 THEN md5(nullif(s, '')) END AS reasoning, CASE k WHEN 0 THEN 'answer ' || reply_id WHEN 1 THEN '' ELSE md5(text) END AS content FROM r""",
)
def _(t):
    k = F.col("turn") % 3
    reply = F.when(k == 0, F.concat(F.lit("<think> "), "text", F.lit("\n</think>\n\nanswer "), F.col("reply_id").cast("string"))).when(k == 1, F.concat(F.lit("<think>"), "text")).otherwise(F.col("text"))
    out = R.split_reasoning(base(t).withColumn("text", reply))
    return out.select("reply_id", F.md5("reasoning").alias("reasoning"), F.when(k == 2, F.md5("content")).otherwise(F.col("content")).alias("content"))


ARGS = """'{"q":"' || 'x' || turn || '","n":' || conv_id || '}'"""


def args():
    return F.concat(F.lit('{"q": "x'), F.col("turn").cast("string"), F.lit('", "n": '), F.col("conv_id").cast("string"), F.lit("}"))


def calls_of(df, fmt):
    out = R.extract_tool_calls(df, fmt)
    c = F.get("calls", F.lit(0))
    return out.select("reply_id", F.size("calls").alias("n_calls"), c["name"].alias("name"), c["arguments"].alias("arguments"), F.md5("content").alias("content"), "error")


def wrapped(t, *parts):
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return base(t).withColumn("text", F.concat(*cols))


ONE = f"SELECT {KEY} AS reply_id, 1::INTEGER AS n_calls, 'find' AS name, {ARGS} AS arguments, md5(%s) AS content, NULL::VARCHAR AS error FROM conversations"


@query(
    "r2_generic",
    f"""SELECT {KEY} AS reply_id, (turn % 3 <> 2)::INTEGER AS n_calls, CASE WHEN turn % 3 <> 2 THEN 'find' END AS name, CASE WHEN turn % 3 <> 2 THEN {ARGS} END AS arguments, md5(CASE WHEN turn % 3 = 2 THEN text ELSE '' END) AS content, NULL::VARCHAR AS error FROM conversations""",
)
def _(t):
    call = F.concat(F.lit('{"name": "find", "arguments": '), args(), F.lit("}"))
    k = F.col("turn") % 3
    body = F.when(k == 0, F.concat(F.lit('{"tool_calls": ['), call, F.lit("]}"))).when(k == 1, F.concat(F.lit('{"tool_call": '), call, F.lit("}"))).otherwise(F.concat(F.lit('{"response": '), j(F.col("text")), F.lit("}")))
    return calls_of(wrapped(t, body), "generic")


@query("r3_prefixed_array", ONE % "text")
def _(t):
    return calls_of(wrapped(t, F.col("text"), '[TOOL_CALLS][{"name": "find", "arguments": ', args(), ', "id": "123456789"}]'), "mistral-nemo")


@query("r3_functools", ONE % "text")
def _(t):
    return calls_of(wrapped(t, F.col("text"), ' functools[{"name": "find", "arguments": ', args(), "}]"), "firefunction-v2")


@query("r4_action_block", ONE % "''")
def _(t):
    return calls_of(wrapped(t, "<|START_THINKING|>", F.col("text"), '<|END_THINKING|><|START_ACTION|>[\n{"tool_call_id": "0", "tool_name": "find", "parameters": ', args(), "}\n]<|END_ACTION|>"), "command-r7b")


@query("r5_named_json", ONE % "''")
def _(t):
    return calls_of(wrapped(t, '{"type": "function", "name": "find", "parameters": ', args(), "}"), "llama3")


@query("r5_builtin_call", ONE % "text")
def _(t):
    return calls_of(wrapped(t, F.col("text"), '<|python_tag|>find.call(q="x', F.col("turn").cast("string"), '", n=', F.col("conv_id").cast("string"), ")"), "llama3-builtin")


@query("r6_tagged_json", ONE % "text || 'tail'")
def _(t):
    k = F.col("turn") % 3
    inner = F.concat(F.lit('{"name": "find", "arguments": '), args(), F.lit("}"))
    body = (
        F.when(k == 0, F.concat(F.lit("<tool_call>\n"), inner, F.lit("\n</tool_call>\n")))
        .when(k == 1, F.concat(F.lit("```json\n<tool>"), inner, F.lit("</tool>\n```\n")))
        .otherwise(F.concat(F.lit("<function=find>"), args(), F.lit("</function>\n")))
    )
    return calls_of(wrapped(t, F.col("text"), body, "tail"), "hermes")


@query("r7_repeated_calls", f"SELECT {KEY} AS reply_id, 2::INTEGER AS n_calls, 'find' AS name, {ARGS} AS arguments, md5(text) AS content, NULL::VARCHAR AS error FROM conversations")
def _(t):
    one = F.concat(F.lit("<｜tool▁call▁begin｜>function<｜tool▁sep｜>find\n```json\n"), args(), F.lit("\n```<｜tool▁call▁end｜>"))
    return calls_of(wrapped(t, F.col("text"), "<｜tool▁calls▁begin｜>", one, one, "<｜tool▁calls▁end｜>"), "deepseek-r1")


@query("r7_functions", f"SELECT {KEY} AS reply_id, 2::INTEGER AS n_calls, 'find' AS name, {ARGS} AS arguments, md5(text) AS content, NULL::VARCHAR AS error FROM conversations")
def _(t):
    one = F.concat(F.lit("<function=find>"), args(), F.lit("</function>"))
    return calls_of(wrapped(t, F.col("text"), one, one), "functionary-3.1")


@query("r7_marked_calls", f"SELECT {KEY} AS reply_id, 2::INTEGER AS n_calls, 'find' AS name, {ARGS} AS arguments, md5(text) AS content, NULL::VARCHAR AS error FROM conversations")
def _(t):
    one = F.concat(F.lit(">>>find\n"), args(), F.lit("\n"))
    return calls_of(wrapped(t, "all\n", F.col("text"), one, one), "functionary-3.2")


STOPS = ["</s>", "the end.", "nd\n"]


@query(
    "r8_partial_stop",
    "WITH p AS (SELECT doc_id, text || ['<', '</s', 'the e', 'n'][doc_id % 4 + 1] AS x FROM documents) SELECT doc_id, (length(x) - [1, 3, 5, 1][doc_id % 4 + 1])::INTEGER AS at FROM p",
)
def _(t):
    tail = F.element_at(F.array(*map(F.lit, ("<", "</s", "the e", "n"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return t.documents.select("doc_id", R.partial_stop(F.concat("text", tail), STOPS).alias("at"))


@query(
    "r9_utf8_tails",
    "SELECT source, count(*) AS rows, count(*) FILTER (doc_id % 3 > 0) AS cut, sum(doc_id % 3)::BIGINT AS bytes_cut, 0::BIGINT AS invalid FROM documents GROUP BY 1",
)
def _(t):
    """The text followed by the first 0, 1 or 2 bytes of a three-byte character."""
    euro = F.encode(F.lit("€"), "UTF-8")
    data = F.concat(F.encode("text", "UTF-8"), F.substr(euro, F.lit(1), (F.col("doc_id") % 3).cast("int")))
    return R.utf8_tail_audit(t.documents.select("source", data.alias("data")))


@query(
    "r10_stop_reasons",
    """WITH s AS (SELECT CASE WHEN event_type = 'error' THEN 'word' WHEN user_id % 3 = 0 THEN 'eos' WHEN event_id % 200 >= 128 OR user_id >= 45 THEN 'limit' ELSE 'none' END AS stop, user_id >= 45 AS truncated FROM events) SELECT stop, count(*) AS n, count(*) FILTER (truncated) AS truncated FROM s GROUP BY 1""",
)
def _(t):
    rows = t.events.select(
        F.when(F.col("event_type") == "error", "x").otherwise("").alias("stop_word"), (F.col("user_id") % 3 == 0).alias("hit_eos"), (F.col("event_id") % 200).alias("n_decoded"), F.lit(128).alias("n_predict"), F.col("user_id").alias("n_past"), F.lit(45).alias("n_ctx")
    )
    return R.stop_tally(rows)


@query(
    "r11_message_deltas",
    """WITH w AS (SELECT conv_id * 1000 + turn AS reply_id, string_split(text, ' ') AS p FROM conversations), s AS (SELECT reply_id, unnest(range(0, 4)) AS seq, p FROM w)
SELECT reply_id, seq::INTEGER AS seq, md5(CASE WHEN seq = 0 THEN coalesce(p[1], '') ELSE CASE WHEN len(p) > seq THEN ' ' || p[seq + 1] ELSE '' END END) AS content_delta, '' AS reasoning_delta, (CASE WHEN seq IN (2) THEN 1 ELSE 0 END)::INTEGER AS new_calls, NULL::VARCHAR AS error FROM s""",
)
def _(t):
    words = F.split("text", " ", -1)
    rows = base(t).select("reply_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seq"), words.alias("w"))
    rows = rows.select("reply_id", "seq", F.array_join(F.slice("w", F.lit(1), F.col("seq") + 1), " ").alias("content"), F.lit("").alias("reasoning"), F.when(F.col("seq") >= 2, 1).otherwise(0).alias("n_calls"))
    out = R.message_deltas(rows)
    return out.select("reply_id", "seq", F.md5("content_delta").alias("content_delta"), "reasoning_delta", "new_calls", "error")


SCHEMA = {
    "type": "object",
    "properties": {
        "role": {"enum": ["user", "assistant"]},
        "turn": {"type": "integer", "minimum": 0, "maximum": 3},
        "text": {"type": "string", "minLength": 80},
        "tags": {"type": "array", "items": {"type": "string"}, "minItems": 1},
    },
    "required": ["role", "turn", "text"],
}


@query(
    "r13_conformance",
    f"""SELECT {KEY} AS reply_id, CASE WHEN role NOT IN ('user', 'assistant') THEN '$.role: not an allowed value' WHEN turn > 3 THEN '$.turn: maximum' WHEN length(text) < 80 THEN '$.text: length' WHEN conv_id % 5 = 0 THEN '$.tags: number of items' END AS reason FROM conversations""",
)
def _(t):
    tags = F.when(F.col("conv_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("role"))
    body = F.to_json(F.struct("role", "turn", "text", tags.alias("tags")))
    return R.conforms(base(t).withColumn("text", body), SCHEMA).select("reply_id", "reason")


@query("r13_rate", "SELECT role AS model, count(*) AS n, count(*) FILTER (length(text) >= 80) AS ok, round(avg((length(text) >= 80)::INTEGER), 9) AS rate FROM conversations GROUP BY 1")
def _(t):
    rows = base(t).withColumn("body", F.to_json(F.struct("text")))
    judged = R.conforms(rows, {"type": "object", "properties": {"text": {"type": "string", "minLength": 80}}, "required": ["text"]}, text="body")
    return R.conformance_rate(judged.withColumn("model", F.col("role")), "model").withColumn("rate", F.round("rate", 9))


@query("r14_judged_calls", f"SELECT {KEY} AS reply_id, turn % 2 = 0 AND turn < 4 AS success FROM conversations")
def _(t):
    name = F.when(F.col("turn") % 2 == 0, "find").otherwise("other")
    rows = wrapped(t, F.lit('{"name": "'), name, '", "parameters": ', args(), "}")
    return R.judge_tool_calls(R.extract_tool_calls(rows, "llama3"), name="find", argument="q", pattern="^x[0-3]$").select("reply_id", "success")
