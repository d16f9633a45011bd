"""Training-row queries over ``documents``, ``conversations`` and ``orders``."""

import re

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.inputs import IDS, doc_ids
from loomspark.functions import text
from loomspark.operators import prep as P
from loomspark.operators import templates as T
from loomspark.plans.prefix import neighbour, running_sums

EOS = "</s>"


def quoted(s):
    return "'" + s.replace("'", "''") + "'"


def sql_fill(template, **slots):
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(quoted(p) if i % 2 == 0 else slots.get(p, p) for i, p in enumerate(parts) if p or i % 2)


INSTR = """ins AS (SELECT d.doc_id, 'Rate this ' || lang || ' text' AS instruction, text AS input, coalesce('quality ' || quality, '') AS output FROM documents d LEFT JOIN labels l USING (doc_id))"""


def instructions(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    return rows.select(
        "doc_id",
        F.concat(F.lit("Rate this "), "lang", F.lit(" text")).alias("instruction"),
        F.col("text").alias("input"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("output"),
    )


@query("p1_alpaca", f"WITH {INSTR} SELECT doc_id, md5({sql_fill(P.ALPACA)} || '{EOS}') AS digest FROM ins")
def _(t):
    return P.format_alpaca(instructions(t), EOS).select("doc_id", F.md5("text").alias("digest"))


@query("p2_reasoning", f"WITH {INSTR} SELECT doc_id, md5({sql_fill(P.REASONING, thought=quoted(''))} || '{EOS}') AS digest FROM ins")
def _(t):
    return P.format_reasoning(instructions(t), EOS).select("doc_id", F.md5("text").alias("digest"))


CUSTOM = "[{domain}] {instruction}: {input} => {output}."


@query("p3_custom_template", f"WITH {INSTR} SELECT doc_id, md5({sql_fill(CUSTOM, domain=quoted('safety'))}) AS digest FROM ins")
def _(t):
    return P.format_template(instructions(t), CUSTOM, domain="safety").select("doc_id", F.md5("text").alias("digest"))


TRIM = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
# per-message SQL of some families: segment, head, generation prompt
_MSG = {
    "chatml": ("'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)", "''", "'<|im_start|>assistant' || chr(10)"),
    "llama3": (f"'<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || {TRIM} || '<|eot_id|>'", "''", "'<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"),
    "vicuna": ("CASE role WHEN 'system' THEN text || chr(10) || chr(10) WHEN 'user' THEN 'USER: ' || text || chr(10) ELSE 'ASSISTANT: ' || text || '</s>' || chr(10) END", "''", "'ASSISTANT:'"),
    "monarch": ("CASE WHEN turn = 0 THEN '' ELSE '<s>' END || role || chr(10) || text || '</s>' || chr(10)", "''", "'<s>assistant' || chr(10)"),
    "mistral-v3": (f"CASE WHEN prev IS NULL OR prev = 'assistant' THEN '[INST] ' ELSE '' END || CASE role WHEN 'system' THEN text || chr(10) || chr(10) WHEN 'user' THEN text || '[/INST]' ELSE ' ' || {TRIM} || '</s>' END", "''", "''"),
    "llama2-sys-bos": ("CASE WHEN prev = 'assistant' THEN '<s>[INST] ' ELSE '' END || CASE role WHEN 'system' THEN '<<SYS>>' || chr(10) || text || chr(10) || '<</SYS>>' || chr(10) || chr(10) WHEN 'user' THEN text || ' [/INST]' ELSE text || '</s>' END", "'[INST] '", "''"),
    "gemma": (f"CASE role WHEN 'system' THEN '' WHEN 'assistant' THEN '<start_of_turn>model' || chr(10) || {TRIM} || '<end_of_turn>' || chr(10) ELSE '<start_of_turn>user' || chr(10) || CASE WHEN prev = 'system' THEN regexp_replace(prev_text, '^\\s+|\\s+$', '', 'g') || chr(10) || chr(10) ELSE '' END || {TRIM} || '<end_of_turn>' || chr(10) END", "''", "'<start_of_turn>model' || chr(10)"),
    "orion": ("CASE role WHEN 'system' THEN '' WHEN 'user' THEN 'Human: ' || CASE WHEN prev = 'system' THEN prev_text || chr(10) || chr(10) ELSE '' END || text || chr(10) || chr(10) || 'Assistant: </s>' ELSE text || '</s>' END", "''", "''"),
    "rwkv-world": (f"CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: ' ELSE 'Assistant: ' END || {TRIM} || chr(10) || chr(10) || CASE WHEN role = 'user' AND nxt IS NULL THEN 'Assistant:' ELSE '' END", "''", "''"),
    "gigachat": ("CASE role WHEN 'system' THEN CASE WHEN turn = 0 THEN text || '<|message_sep|>' ELSE '' END WHEN 'user' THEN 'user<|role_sep|>' || text || '<|message_sep|>available functions<|role_sep|>[]<|message_sep|>' ELSE 'assistant<|role_sep|>' || text || '<|message_sep|>' END", "'<s>'", "'assistant<|role_sep|>'"),
}

TURNS = "m AS (SELECT *, lag(role) OVER w AS prev, lag(text) OVER w AS prev_text, lead(role) OVER w AS nxt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"


def _template_query(family):
    seg, head, tail = _MSG[family]

    @query(
        f"p4_{family.replace('-', '_')}",
        f"WITH {TURNS}, s AS (SELECT conv_id, turn, {seg} AS seg FROM m) SELECT conv_id, md5({head} || string_agg(seg, '' ORDER BY turn) || {tail}) AS digest FROM s GROUP BY 1",
    )
    def _(t):
        return T.apply_chat_template(t.conversations, family).select("conv_id", F.md5("prompt").alias("digest"))


# What other families write for a system, a user and an assistant message (%s), in front of and behind all of them, whether
# texts are trimmed, and what opens a turn at the start and after a reply.
_THREE = {
    "phi3": ("<|system|>\n%s<|end|>\n", "<|user|>\n%s<|end|>\n", "<|assistant|>\n%s<|end|>\n", "", "<|assistant|>\n", False, "", ""),
    "phi4": ("<|im_start|>system<|im_sep|>%s<|im_end|>", "<|im_start|>user<|im_sep|>%s<|im_end|>", "<|im_start|>assistant<|im_sep|>%s<|im_end|>", "", "<|im_start|>assistant<|im_sep|>", False, "", ""),
    "falcon3": ("<|system|>\n%s\n", "<|user|>\n%s\n", "<|assistant|>\n%s\n", "", "<|assistant|>\n", False, "", ""),
    "zephyr": ("<|system|>\n%s<|endoftext|>\n", "<|user|>\n%s<|endoftext|>\n", "<|assistant|>\n%s<|endoftext|>\n", "", "<|assistant|>\n", False, "", ""),
    "openchat": ("%s<|end_of_turn|>", "GPT4 Correct User: %s<|end_of_turn|>", "GPT4 Correct Assistant: %s<|end_of_turn|>", "", "GPT4 Correct Assistant:", False, "", ""),
    "vicuna-orca": ("SYSTEM: %s\n", "USER: %s\n", "ASSISTANT: %s</s>\n", "", "ASSISTANT:", False, "", ""),
    "deepseek": ("%s", "### Instruction:\n%s\n", "### Response:\n%s\n<|EOT|>\n", "", "### Response:\n", False, "", ""),
    "deepseek2": ("%s\n\n", "User: %s\n\n", "Assistant: %s<｜end▁of▁sentence｜>", "", "Assistant:", False, "", ""),
    "deepseek3": ("%s\n\n", "<｜User｜>%s", "<｜Assistant｜>%s<｜end▁of▁sentence｜>", "", "<｜Assistant｜>", False, "", ""),
    "command-r": ("<|START_OF_TURN_TOKEN|><|SYSTEM_TOKEN|>%s<|END_OF_TURN_TOKEN|>", "<|START_OF_TURN_TOKEN|><|USER_TOKEN|>%s<|END_OF_TURN_TOKEN|>", "<|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>%s<|END_OF_TURN_TOKEN|>", "", "<|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>", True, "", ""),
    "chatglm3": ("<|system|>\n %s", "<|user|>\n %s", "<|assistant|>\n %s", "[gMASK]sop", "<|assistant|>", False, "", ""),
    "chatglm4": ("<|system|>\n%s", "<|user|>\n%s", "<|assistant|>\n%s", "[gMASK]<sop>", "<|assistant|>\n", False, "", ""),
    "glmedge": ("<|system|>\n%s", "<|user|>\n%s", "<|assistant|>\n%s", "", "<|assistant|>", False, "", ""),
    "minicpm": ("%s", "<用户>%s<AI>", "%s", "", "", True, "", ""),
    "exaone3": ("[|system|]%s[|endofturn|]\n", "[|user|]%s\n", "[|assistant|]%s[|endofturn|]\n", "", "[|assistant|]", True, "", ""),
    "granite": ("<|start_of_role|>system<|end_of_role|>%s<|end_of_text|>\n", "<|start_of_role|>user<|end_of_role|>%s<|end_of_text|>\n", "<|start_of_role|>assistant<|end_of_role|>%s<|end_of_text|>\n", "", "<|start_of_role|>assistant<|end_of_role|>\n", False, "", ""),
    "megrez": ("<|role_start|>system<|role_end|>%s<|turn_end|>", "<|role_start|>user<|role_end|>%s<|turn_end|>", "<|role_start|>assistant<|role_end|>%s<|turn_end|>", "", "<|role_start|>assistant<|role_end|>", False, "", ""),
    "yandex": ("", " Пользователь: %s\n\n", " Ассистент: %s\n\n", "<s>", " Ассистент:[SEP]", False, "", ""),
    "bailing": ("<role>SYSTEM</role>%s", "<role>HUMAN</role>%s", "<role>ASSISTANT</role>%s", "", "<role>ASSISTANT</role>", False, "", ""),
    "llama4": ("<|header_start|>system<|header_end|>\n\n%s<|eot|>", "<|header_start|>user<|header_end|>\n\n%s<|eot|>", "<|header_start|>assistant<|header_end|>\n\n%s<|eot|>", "", "<|header_start|>assistant<|header_end|>\n\n", True, "", ""),
    "smolvlm": ("%s\n\n", "User: %s<end_of_utterance>\n", "Assistant: %s<end_of_utterance>\n", "<|im_start|>", "Assistant:", False, "", ""),
    "dots1": ("<|system|>%s<|endofsystem|>", "<|userprompt|>%s<|endofuserprompt|>", "<|response|>%s<|endofresponse|>", "", "<|response|>", False, "", ""),
    "mistral-v7": ("[SYSTEM_PROMPT] %s[/SYSTEM_PROMPT]", "[INST] %s[/INST]", " %s</s>", "", "", False, "", ""),
    "mistral-v7-tekken": ("[SYSTEM_PROMPT]%s[/SYSTEM_PROMPT]", "[INST]%s[/INST]", "%s</s>", "", "", False, "", ""),
    "llama2": ("%s\n", "%s [/INST]", "%s</s>", "[INST] ", "", False, "", "[INST] "),
    "llama2-sys": ("<<SYS>>\n%s\n<</SYS>>\n\n", "%s [/INST]", "%s</s>", "[INST] ", "", False, "", "[INST] "),
    "llama2-sys-strip": ("<<SYS>>\n%s\n<</SYS>>\n\n", "%s [/INST]", "%s</s>", "[INST] ", "", True, "", "[INST] "),
    "mistral-v1": ("%s\n\n", "%s [/INST]", " %s</s>", "", "", False, " [INST] ", " [INST] "),
    "mistral-v3-tekken": ("%s\n\n", "%s[/INST]", "%s</s>", "", "", False, "[INST]", "[INST]"),
}


def _three(system, user, reply, head, tail, trim, start, after):
    body = TRIM if trim else "text"
    said = lambda x: " || ".join(quoted(p) if i % 2 == 0 else body for i, p in enumerate(re.split("(%s)", x)) if p) or "''"
    seg = f"CASE WHEN turn = 0 THEN {quoted(start)} WHEN prev = 'assistant' THEN {quoted(after)} ELSE '' END || CASE role WHEN 'system' THEN {said(system)} WHEN 'user' THEN {said(user)} ELSE {said(reply)} END"
    return seg, quoted(head), quoted(tail)


_MSG |= {family: _three(*marks) for family, marks in _THREE.items()}

for _family in _MSG:
    _template_query(_family)


@query("p4_all_families")
def _(t):
    """Every family rendered for every conversation; goldens are in the tests."""
    out = None
    for family in T.FAMILIES:
        rows = T.apply_chat_template(t.conversations, family).select("conv_id", F.lit(family).alias("family"), F.md5("prompt").alias("digest"))
        out = rows if out is None else out.unionByName(rows)
    return out


_SIGNS = ["<|im_start|>", "<|im_start|> <|im_sep|>", "[INST] <<SYS>>", "[INST] [AVAILABLE_TOOLS]", "<|assistant|> <|end|>", "[gMASK]sop", "<start_of_turn>", "<|header_start|> <|header_end|>", "nothing"]
_KINDS = ["chatml", "phi4", "llama2-sys", "mistral-v1", "phi3", "chatglm3", "gemma", "llama4", "unknown"]


@query(
    "p5_detect_template",
    f"SELECT conv_id, turn, {_KINDS}[(conv_id + turn) % {len(_KINDS)} + 1] AS family FROM conversations",
)
def _(t):
    sign = F.element_at(F.array(*map(F.lit, _SIGNS)), ((F.col("conv_id") + F.col("turn")) % len(_SIGNS) + 1).cast("int"))
    return t.conversations.select("conv_id", "turn", T.detect_chat_template(F.concat("text", F.lit(" "), sign)).alias("family"))


def api_bodies(t):
    """One JSON body per message: a plain text, typed parts, a tool call, or a broken form, by turn."""
    j = lambda *cols: F.to_json(F.struct(*cols))
    role = F.col("role")
    plain = j(role, F.col("text").alias("content"))
    parts = j(role, F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))).alias("content"))
    fn = F.struct(F.concat(F.lit("f"), F.col("turn").cast("string")).alias("name"), F.lit("{}").alias("arguments"))
    call = j(role, F.array(F.struct(F.lit("function").alias("type"), fn.alias("function"))).alias("tool_calls"))
    image = j(role, F.array(F.struct(F.lit("image").alias("type"))).alias("content"))
    bare = j(role)
    k = (F.col("conv_id") + F.col("turn")) % 5
    body = F.when(k == 0, plain).when(k == 1, parts).when(k == 2, call).when(k == 3, image).otherwise(bare)
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("body_id")
    return t.conversations.select(key, F.concat(F.lit("["), body, F.lit("]")).alias("body"))


@query(
    "p6_parse_messages",
    """WITH k AS (SELECT conv_id * 1000 + turn AS body_id, role, text, turn, (conv_id + turn) % 5 AS k FROM conversations)
SELECT body_id, 0::INTEGER AS msg_no, role, CASE WHEN k = 0 THEN md5(text) END AS content, CASE WHEN k = 1 THEN md5(text) END AS part, CASE WHEN k = 2 THEN 'f' || turn END AS tool,
 CASE k WHEN 3 THEN 'unsupported content part type' WHEN 4 THEN 'expected content or tool_calls' END AS error FROM k""",
)
def _(t):
    rows = P.parse_messages(api_bodies(t), "body", key="body_id")
    return rows.select(
        "body_id", "msg_no", "role", F.md5("content").alias("content"),
        F.md5(F.get("content_parts", F.lit(0))["text"]).alias("part"), F.get("tool_calls", F.lit(0))["name"].alias("tool"), "error",
    )


@query(
    "p7_messages_to_json",
    """WITH k AS (SELECT conv_id * 1000 + turn AS body_id, role, text, turn, (conv_id + turn) % 5 AS k FROM conversations)
SELECT body_id, role, CASE WHEN k IN (0, 1) THEN md5(text) END AS content, CASE WHEN k = 2 THEN '{"type":"function","function":{"name":"f' || turn || '","arguments":"{}"}}' END AS tool FROM k WHERE k < 3""",
)
def _(t):
    good = P.parse_messages(api_bodies(t), "body", key="body_id").filter("error IS NULL")
    rows = P.messages_to_json(good, join_text=True)
    pick = lambda p: F.get_json_object("message", p)
    return rows.select("body_id", pick("$.role").alias("role"), F.md5(pick("$.content")).alias("content"), pick("$.tool_calls[0]").alias("tool"))


@query(
    "p8_select_prompts",
    r"""WITH a AS (SELECT conv_id, count(*) AS n, arg_min(role, turn) AS r0, arg_min(text, turn) AS prompt, max(CASE WHEN turn = 1 THEN text END) AS reply FROM conversations GROUP BY 1),
b AS (SELECT conv_id, prompt, len(string_split_regex(prompt, '[\s,''".?]'))::INTEGER AS n_prompt, len(string_split_regex(reply, '[\s,''".?]'))::INTEGER AS n_reply FROM a WHERE n >= 2 AND r0 = 'user')
SELECT conv_id, md5(prompt) AS digest, n_prompt, n_reply FROM b WHERE n_prompt >= 4 AND n_reply >= 4 AND n_prompt <= 400 AND n_prompt + n_reply <= 600 ORDER BY conv_id LIMIT 40""",
)
def _(t):
    at = lambda k: F.max(F.when(F.col("turn") == k, F.col("text")))
    role = F.max(F.when(F.col("turn") == 0, F.col("role")))
    rows = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n_turns"), role.alias("r"), at(0).alias("prompt"), at(1).alias("reply"))
    rows = rows.withColumn("first_from", F.when(F.col("r") == "user", "human").otherwise(F.col("r")))
    return P.select_prompts(rows, 400, 600, 40).select("conv_id", F.md5("prompt").alias("digest"), "n_prompt", "n_reply")


CONV_IDS = "ci AS (SELECT conv_id, turn, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), lambda t: ((ascii(t) * 31 + length(t)) % 97)::INTEGER) AS a FROM conversations), pr AS (SELECT x.conv_id, x.turn, x.a AS q, y.a AS d FROM ci x JOIN ci y ON y.conv_id = x.conv_id AND y.turn = x.turn + 1)"


def id_pairs(t):
    rows = t.conversations.select("conv_id", "turn", text.word_ids(text.words("text")).alias("q"))
    return neighbour(rows, ["conv_id"], "turn", ["q"], 1).filter("next_q IS NOT NULL").withColumnRenamed("next_q", "d")


def listed(c):
    return F.md5(F.array_join(F.col(c).cast("array<string>"), " "))


@query(
    "p9_rerank_pairs",
    f"WITH {CONV_IDS} SELECT conv_id, turn, md5(array_to_string(list_concat([101], q, [103, 103], d, [103]), ' ')) AS digest FROM pr",
)
def _(t):
    rows = id_pairs(t).withColumn("tokens", P.format_rerank("q", "d", bos=101, eos=None, sep=103))
    return rows.select("conv_id", "turn", listed("tokens").alias("digest"))


@query("p10_pair_text", "SELECT doc_id, md5(array_to_string(string_split(text, ' the '), '</s><sep>')) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(P.format_pairs("text", " the ", "</s>", "<sep>")).alias("digest"))


@query(
    "p11_infill",
    f"""WITH {CONV_IDS}, e AS (SELECT conv_id, turn, q, d, list_concat([1, 50, 51], [2, 60], d, [2, 61]) AS x FROM pr)
SELECT conv_id, turn, md5(array_to_string(list_concat(x[greatest(1, len(x) - 100 + 1):], [9], [3], q[greatest(1, len(q) - 96 + 1):], q[:2], [4], d[:greatest(0, 32 - (2 + len(q[:2])))], [5]), ' ')) AS digest FROM e""",
)
def _(t):
    extra = F.array(F.struct(F.array(F.lit(60)).alias("name"), F.col("d").alias("tokens")))
    rows = id_pairs(t).select("conv_id", "turn", F.col("q").alias("prefix"), F.col("d").alias("suffix"), F.slice("q", 1, 2).alias("prompt"), extra.alias("extra"))
    out = P.format_infill(rows, n_batch=128, n_predict=14, n_ctx=256, pre=3, suf=4, mid=5, bos=9, rep=1, sep=2, repo_name=[50, 51], file_name=[61])
    return out.select("conv_id", "turn", listed("tokens").alias("digest"))


@query(
    "p12_needles",
    f"""WITH o AS (SELECT o_orderkey AS id, (o_orderkey * 7919) % 50000 + 1 AS passkey, (o_custkey % 10)::INTEGER AS pos FROM orders)
SELECT id, passkey, pos, md5({quoted(P.NEEDLE_HEAD)} || repeat({quoted(P.NEEDLE_JUNK)}, pos) || ' The pass key is ' || passkey || '. Remember it. ' || passkey || ' is the pass key.' || repeat({quoted(P.NEEDLE_JUNK)}, 10 - pos) || {quoted(P.NEEDLE_TAIL)}) AS digest FROM o""",
)
def _(t):
    ids = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    rows = P.make_needles(ids, 10, key=(F.col("id") * 7919) % 50000 + 1, at=F.col("o_custkey") % 10)
    return rows.select("id", "passkey", "pos", F.md5("prompt").alias("digest"))


@query(
    "p14_truncate",
    f"WITH {IDS}, d AS (SELECT doc_id, list(token_id ORDER BY pos) AS a FROM ids GROUP BY 1) SELECT doc_id, least(len(a), 256)::INTEGER AS n, md5(array_to_string(a[:256], ' ')) AS digest FROM d",
)
def _(t):
    rows = P.truncate_tokens(doc_ids(t), 256).filter(F.size("tokens") > 0)
    return rows.select("doc_id", F.size("tokens").alias("n"), listed("tokens").alias("digest"))


@query("p15_sample_invariants", "SELECT least(50, count(*)) AS n, least(50, count(*)) AS n_distinct, least(50, count(*)) AS n_known, 0::BIGINT AS n_other FROM labels")
def _(t):
    """Size, distinct keys, keys of the table, and rows that a second draw has and the first has not."""
    first, second = (P.sample_tasks(t.labels.repartition(parts), 50, key="doc_id").select("doc_id") for parts in (3, 5))
    known = first.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    counts = [first.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_distinct")), known.agg(F.count("*").alias("n_known")), second.join(first, "doc_id", "left_anti").agg(F.count("*").alias("n_other"))]
    return counts[0].join(F.broadcast(counts[1])).join(F.broadcast(counts[2]))  # a row each


@query("p15_sample_tasks")
def _(t):
    return P.sample_tasks(t.labels, 50, key="doc_id")


@query(
    "p16_split",
    "WITH n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM labels) SELECT doc_id, quality, CASE WHEN i < floor(n * 0.95::DOUBLE) THEN 'train' ELSE 'validation' END AS part FROM n",
)
def _(t):
    return P.split_by_position(t.labels, 0.95, key="doc_id").select("doc_id", "quality", "part")


SHARDS = """i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM labels), n AS (SELECT count(*) // 8 AS n FROM labels),
s AS (SELECT g AS shard, row_number() OVER (ORDER BY (g * 7919 + 13) % 1009, g) - 1 AS place FROM n, unnest(range(n)) AS r(g)),
sh AS (SELECT doc_id, idx, idx // 8 AS shard, coalesce(place, idx // 8) AS place, idx // 8 < (SELECT n FROM n) AS whole FROM i LEFT JOIN s ON s.shard = idx // 8)"""


def shards(t):
    rows = running_sums(t.labels.select("doc_id"), [], "doc_id", {"idx": F.lit(1).cast("long")}, inclusive=False)
    return P.shuffle_shards(rows, 8, draw=(F.col("shard") * 7919 + 13) % 1009)


@query("p17_shuffle_shards", f"WITH {SHARDS} SELECT doc_id, idx, shard, place, whole FROM sh")
def _(t):
    return shards(t)


@query("p18_batches", f"WITH {SHARDS} SELECT doc_id, shard, place // 4 AS batch, place // 4 < (SELECT n // 4 FROM n) AS \"full\" FROM sh")
def _(t):
    return P.assign_batches(shards(t), 4).select("doc_id", "shard", "batch", "full")


@query(
    "p19_pad_pairs",
    f"WITH {CONV_IDS} SELECT conv_id, turn, greatest(len(q), len(d))::INTEGER AS n, md5(array_to_string(list_concat(q, list_resize([]::INTEGER[], greatest(0, len(d) - len(q)), 7)), ' ')) AS a, md5(array_to_string(list_concat(d, list_resize([]::INTEGER[], greatest(0, len(q) - len(d)), 7)), ' ')) AS b FROM pr",
)
def _(t):
    rows = P.pad_pairs(id_pairs(t), 7, a="q", b="d")
    return rows.select("conv_id", "turn", F.size("q").alias("n"), listed("q").alias("a"), listed("d").alias("b"))


@query(
    "p20_file_names",
    r"""WITH c AS (SELECT page_id, url, replace(replace(url, 'https://', ''), 'http://', '') AS u FROM pages), n AS (SELECT page_id, unnest([url, replace(u, '/', '_'), split_part(u, '/', 1), u[:12] || CASE WHEN page_id % 2 = 0 THEN '.' ELSE '' END]) AS name, unnest([0, 1, 2, 3])::INTEGER AS kind FROM c)
SELECT page_id, kind, NOT regexp_matches(name, '[\x00-\x1F/\\:*?"<>|]') AND strlen(name) BETWEEN 1 AND 255 AND NOT regexp_matches(name, '^ |[ .]$') AND NOT contains(name, '..') AS ok FROM n""",
)
def _(t):
    u = F.regexp_replace("url", "^https?://", "")
    names = F.array(F.col("url"), F.replace(u, F.lit("/"), F.lit("_")), F.split_part(u, F.lit("/"), F.lit(1)), F.concat(F.substring(u, 1, 12), F.when(F.col("page_id") % 2 == 0, ".").otherwise("")))
    rows = t.pages.select("page_id", F.posexplode(names).alias("kind", "name"))
    return rows.select("page_id", "kind", P.valid_file_name("name").alias("ok"))
