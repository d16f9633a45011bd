"""Chat templates as tables of markers, and their detection.

A family is data: what stands before and after a message of each role.  Segments are computed per message; the
few families that look at neighbours get them through equi-joins on ``(conversation, turn)``, so one long
conversation spreads over all tasks.  Putting segments together goes through blocks of turns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import strip
from loomspark.plans.prefix import neighbour, running_sums

TURN_BLOCK = 1_024

Marks = tuple[str, str]


@dataclass(frozen=True)
class Family:
    """Markers of one template.  ``{role}`` in a marker is the message's role, ``{Role}`` / ``{ROLE}`` its cased form."""

    roles: dict[str, Marks] = field(default_factory=dict)
    other: Marks | None = None  # roles not listed; None leaves them out
    head: str = ""  # in front of everything
    prompt: str = ""  # asks for a reply
    strip: bool = False  # trim every text
    strip_reply: bool = False  # trim what is neither system nor user
    first: str | None = None  # in front of the first message instead of `rest`
    rest: str = ""  # in front of later messages
    open_first: str = ""  # opens a turn at the start
    open_next: str = ""  # opens a turn after a reply
    hold: str = ""  # system text waits for this role: "user", or "any" but the assistant
    last_user: str = ""  # behind a user message that ends the conversation
    lead_system: Marks | None = None  # a system message that starts the conversation


def _same(before: str, after: str, prompt: str = "", **kw) -> Family:
    return Family(other=(before, after), prompt=prompt, **kw)


_EOS3 = "<｜end▁of▁sentence｜>"
_INST = {"system": ("", "\n\n"), "user": ("", "[/INST]")}

# Marker strings of each family: fixed values.
FAMILIES: dict[str, Family] = {
    "chatml": _same("<|im_start|>{role}\n", "<|im_end|>\n", "<|im_start|>assistant\n"),
    "llama2": Family({"system": ("", "\n"), "user": ("", " [/INST]")}, ("", "</s>"), head="[INST] ", open_next="[INST] "),
    "llama2-sys": Family({"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("", " [/INST]")}, ("", "</s>"), head="[INST] ", open_next="[INST] "),
    "llama2-sys-bos": Family({"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("", " [/INST]")}, ("", "</s>"), head="[INST] ", open_next="<s>[INST] "),
    "llama2-sys-strip": Family({"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("", " [/INST]")}, ("", "</s>"), head="[INST] ", open_next="[INST] ", strip=True),
    "mistral-v1": Family({"system": ("", "\n\n"), "user": ("", " [/INST]")}, (" ", "</s>"), open_first=" [INST] ", open_next=" [INST] "),
    "mistral-v3": Family(_INST, (" ", "</s>"), open_first="[INST] ", open_next="[INST] ", strip_reply=True),
    "mistral-v3-tekken": Family(_INST, ("", "</s>"), open_first="[INST]", open_next="[INST]"),
    "mistral-v7": Family({"system": ("[SYSTEM_PROMPT] ", "[/SYSTEM_PROMPT]"), "user": ("[INST] ", "[/INST]")}, (" ", "</s>")),
    "mistral-v7-tekken": Family({"system": ("[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]"), "user": ("[INST]", "[/INST]")}, ("", "</s>")),
    "phi3": _same("<|{role}|>\n", "<|end|>\n", "<|assistant|>\n"),
    "phi4": _same("<|im_start|>{role}<|im_sep|>", "<|im_end|>", "<|im_start|>assistant<|im_sep|>"),
    "falcon3": _same("<|{role}|>\n", "\n", "<|assistant|>\n"),
    "zephyr": _same("<|{role}|>\n", "<|endoftext|>\n", "<|assistant|>\n"),
    "monarch": _same("{role}\n", "</s>\n", "<s>assistant\n", first="", rest="<s>"),
    "gemma": Family({"assistant": ("<start_of_turn>model\n", "<end_of_turn>\n")}, ("<start_of_turn>{role}\n", "<end_of_turn>\n"), prompt="<start_of_turn>model\n", strip=True, hold="any"),
    "orion": Family({"user": ("Human: ", "\n\nAssistant: </s>")}, ("", "</s>"), hold="user"),
    "openchat": Family({"system": ("", "<|end_of_turn|>")}, ("GPT4 Correct {Role}: ", "<|end_of_turn|>"), prompt="GPT4 Correct Assistant:"),
    "vicuna": Family({"system": ("", "\n\n"), "user": ("USER: ", "\n"), "assistant": ("ASSISTANT: ", "</s>\n")}, prompt="ASSISTANT:"),
    "vicuna-orca": Family({"system": ("SYSTEM: ", "\n"), "user": ("USER: ", "\n"), "assistant": ("ASSISTANT: ", "</s>\n")}, prompt="ASSISTANT:"),
    "deepseek": Family({"system": ("", ""), "user": ("### Instruction:\n", "\n"), "assistant": ("### Response:\n", "\n<|EOT|>\n")}, prompt="### Response:\n"),
    "deepseek2": Family({"system": ("", "\n\n"), "user": ("User: ", "\n\n"), "assistant": ("Assistant: ", _EOS3)}, prompt="Assistant:"),
    "deepseek3": Family({"system": ("", "\n\n"), "user": ("<｜User｜>", ""), "assistant": ("<｜Assistant｜>", _EOS3)}, prompt="<｜Assistant｜>"),
    "command-r": Family(
        {r: (f"<|START_OF_TURN_TOKEN|><|{m}_TOKEN|>", "<|END_OF_TURN_TOKEN|>") for r, m in (("system", "SYSTEM"), ("user", "USER"), ("assistant", "CHATBOT"))},
        prompt="<|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>", strip=True,
    ),
    "llama3": _same("<|start_header_id|>{role}<|end_header_id|>\n\n", "<|eot_id|>", "<|start_header_id|>assistant<|end_header_id|>\n\n", strip=True),
    "chatglm3": _same("<|{role}|>\n ", "", "<|assistant|>", head="[gMASK]sop"),
    "chatglm4": _same("<|{role}|>\n", "", "<|assistant|>\n", head="[gMASK]<sop>"),
    "glmedge": _same("<|{role}|>\n", "", "<|assistant|>"),
    "minicpm": Family({"user": ("<用户>", "<AI>")}, ("", ""), strip=True),
    "exaone3": Family({"system": ("[|system|]", "[|endofturn|]\n"), "user": ("[|user|]", "\n"), "assistant": ("[|assistant|]", "[|endofturn|]\n")}, prompt="[|assistant|]", strip=True),
    "rwkv-world": Family({"system": ("System: ", "\n\n"), "user": ("User: ", "\n\n"), "assistant": ("Assistant: ", "\n\n")}, strip=True, last_user="Assistant:"),
    "granite": Family({"assistant_tool_call": ("<|start_of_role|>{role}<|end_of_role|><|tool_call|>", "<|end_of_text|>\n")}, ("<|start_of_role|>{role}<|end_of_role|>", "<|end_of_text|>\n"), prompt="<|start_of_role|>assistant<|end_of_role|>\n"),
    "gigachat": Family(
        {"user": ("user<|role_sep|>", "<|message_sep|>available functions<|role_sep|>[]<|message_sep|>"), "assistant": ("assistant<|role_sep|>", "<|message_sep|>")},
        head="<s>", prompt="assistant<|role_sep|>", lead_system=("", "<|message_sep|>"),
    ),
    "megrez": _same("<|role_start|>{role}<|role_end|>", "<|turn_end|>", "<|role_start|>assistant<|role_end|>"),
    "yandex": Family({"user": (" Пользователь: ", "\n\n"), "assistant": (" Ассистент: ", "\n\n")}, head="<s>", prompt=" Ассистент:[SEP]"),
    "bailing": Family({"user": ("<role>HUMAN</role>", "")}, ("<role>{ROLE}</role>", ""), prompt="<role>ASSISTANT</role>"),
    "llama4": _same("<|header_start|>{role}<|header_end|>\n\n", "<|eot|>", "<|header_start|>assistant<|header_end|>\n\n", strip=True),
    "smolvlm": Family({"system": ("", "\n\n"), "user": ("User: ", "<end_of_utterance>\n")}, ("Assistant: ", "<end_of_utterance>\n"), head="<|im_start|>", prompt="Assistant:"),
    "dots1": Family({"system": ("<|system|>", "<|endofsystem|>"), "user": ("<|userprompt|>", "<|endofuserprompt|>")}, ("<|response|>", "<|endofresponse|>"), prompt="<|response|>"),
}

# Families that can be asked for by name; one is only ever detected.
NAMED = [n for n in FAMILIES if n != "dots1"]


def _marker(mark: str) -> Column:
    role = F.col("role")
    cased = {"{role}": role, "{Role}": F.concat(F.upper(F.substring(role, 1, 1)), F.expr("substring(role, 2)")), "{ROLE}": F.upper(role)}
    for slot, col in cased.items():
        if slot in mark:
            before, after = mark.split(slot)
            return F.concat(F.lit(before), col, F.lit(after))
    return F.lit(mark)


def _reply(role) -> Column:
    return ~F.coalesce(role.isin("system", "user"), F.lit(True))


def render_segments(df: DataFrame, family: str, *, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``(conv, turn, segment)``: the rendered text of each message.  Turns count 0, 1, 2 … within a conversation."""
    fam = FAMILIES[family]
    rows = df.select(conv, turn, "role", "text")
    text = F.col("text")
    if fam.strip:
        text = strip(text)
    elif fam.strip_reply:
        text = F.when(_reply(F.col("role")), strip(text)).otherwise(text)
    body = F.when(F.lit(False), F.lit(""))
    if fam.lead_system:
        lead = (F.col(turn) == 0) & (F.col("role") == "system")
        body = body.when(lead, F.concat(_marker(fam.lead_system[0]), text, _marker(fam.lead_system[1])))
    held = F.lit("")
    if fam.hold:
        rows = _with_held(rows, conv, turn, fam)
        body = body.when(F.col("role") == "system", F.lit(""))
        held = F.when(F.col("held") != "", F.concat("held", F.lit("\n\n"))).otherwise("")
    for role, (before, after) in fam.roles.items():
        waits = held if fam.hold == "any" and role != "assistant" or fam.hold == role else F.lit("")
        body = body.when(F.col("role") == role, F.concat(_marker(before), waits, text, _marker(after)))
    if fam.other:
        waits = held if fam.hold == "any" else F.lit("")
        body = body.otherwise(F.concat(_marker(fam.other[0]), waits, text, _marker(fam.other[1])))
    else:
        body = body.otherwise("")
    if fam.open_first or fam.open_next:
        rows = neighbour(rows, [conv], turn, ["role"], -1)
        opener = F.when(F.col(turn) == 0, fam.open_first).when(_reply(F.col("prev_role")), fam.open_next).otherwise("")
        body = F.concat(opener, body)
    if fam.first is not None:
        body = F.concat(F.when(F.col(turn) == 0, fam.first).otherwise(fam.rest), body)
    if fam.last_user:
        rows = neighbour(rows, [conv], turn, ["role"], 1)
        body = F.concat(body, F.when((F.col("role") == "user") & F.col("next_role").isNull(), fam.last_user).otherwise(""))
    return rows.select(conv, turn, body.alias("segment"))


def _with_held(rows: DataFrame, conv: str, turn: str, fam: Family) -> DataFrame:
    """Add ``held``: the system text waiting at each message that may take it."""
    takes = (F.col("role") == "user") if fam.hold == "user" else ~F.col("role").isin("system", "assistant")
    numbered = running_sums(rows.withColumn("takes", takes), [conv], turn, {"slot": F.col("takes").cast("long")}, inclusive=False)
    text = strip("text") if fam.strip else F.col("text")
    waiting = numbered.filter(F.col("role") == "system").groupBy(conv, "slot").agg(F.array_sort(F.collect_list(F.struct(turn, text.alias("t")))).alias("w"))
    waiting = waiting.select(conv, "slot", F.array_join(F.transform("w", lambda e: e["t"]), "").alias("__held"))
    joined = numbered.join(waiting, [conv, "slot"], "left")
    return joined.withColumn("held", F.when(F.col("takes"), F.coalesce("__held", F.lit(""))).otherwise("")).drop("__held", "slot", "takes")


def apply_chat_template(df: DataFrame, family: str, add_prompt: bool = True, *, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``(conv, prompt)``: one rendered conversation per row."""
    fam = FAMILIES[family]
    seg = render_segments(df, family, conv=conv, turn=turn).withColumn("blk", F.floor(F.col(turn) / TURN_BLOCK))
    blocks = seg.groupBy(conv, "blk").agg(F.array_sort(F.collect_list(F.struct(turn, "segment"))).alias("s"))
    parts = blocks.select(conv, "blk", F.array_join(F.transform("s", lambda e: e["segment"]), "").alias("part"))
    whole = parts.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct("blk", "part"))).alias("p"))
    body = F.array_join(F.transform("p", lambda e: e["part"]), "")
    return whole.select(conv, F.concat(F.lit(fam.head), body, F.lit(fam.prompt if add_prompt else "")).alias("prompt"))


# ------------------------------------------------------------------ detection

_INST_KIND = ("[INST]",)
_OFFICIAL = [["' [INST] ' + system_message"], ["[AVAILABLE_TOOLS]"]]
# Containment ladder, first match wins: (family, all of these, any of these groups).  Fixed values.
LADDER: list[tuple[str, tuple[str, ...], list[list[str]]]] = [
    ("phi4", ("<|im_start|>", "<|im_sep|>"), []),
    ("smolvlm", ("<|im_start|>", "<end_of_utterance>"), []),
    ("chatml", ("<|im_start|>",), []),
    ("mistral-v7", (*_INST_KIND, "[SYSTEM_PROMPT]"), []),
    ("mistral-v1", (*_INST_KIND, " [INST]"), _OFFICIAL),
    ("mistral-v3-tekken", (*_INST_KIND, '"[INST]"'), _OFFICIAL),
    ("mistral-v3", _INST_KIND, _OFFICIAL),
    ("llama2-sys-strip", (*_INST_KIND, "content.strip()"), []),
    ("llama2-sys-bos", (*_INST_KIND, "bos_token + '[INST]"), []),
    ("llama2-sys", (*_INST_KIND, "<<SYS>>"), []),
    ("llama2", _INST_KIND, []),
    ("phi3", ("<|assistant|>", "<|end|>"), []),
    ("chatglm4", ("[gMASK]<sop>",), []),
    ("falcon3", ("<|assistant|>", "<|user|>", "</s>"), []),
    ("glmedge", ("<|assistant|>", "<|user|>"), []),
    ("glmedge", ("<|{{ item['role'] }}|>", "<|begin_of_image|>"), []),
    ("zephyr", ("<|user|>", "<|endoftext|>"), []),
    ("monarch", ("bos_token + message['role']",), []),
    ("gemma", ("<start_of_turn>",), []),
    ("orion", ("'\\n\\nAssistant: ' + eos_token",), []),
    ("openchat", ("GPT4 Correct ",), []),
    ("vicuna-orca", ("USER: ", "ASSISTANT: ", "SYSTEM: "), []),
    ("vicuna", ("USER: ", "ASSISTANT: "), []),
    ("deepseek", ("### Instruction:", "<|EOT|>"), []),
    ("command-r", ("<|START_OF_TURN_TOKEN|>", "<|USER_TOKEN|>"), []),
    ("llama3", ("<|start_header_id|>", "<|end_header_id|>"), []),
    ("chatglm3", ("[gMASK]sop",), []),
    ("minicpm", ("<用户>",), []),
    ("deepseek2", ("'Assistant: ' + message['content'] + eos_token",), []),
    ("deepseek3", ("<｜Assistant｜>", "<｜User｜>", _EOS3), []),
    ("exaone3", ("[|system|]", "[|assistant|]", "[|endofturn|]"), []),
    ("rwkv-world", ("rwkv-world",), []),
    ("granite", ("<|start_of_role|>",), []),
    ("gigachat", ("message['role'] + additional_special_tokens[0] + message['content'] + additional_special_tokens[1]",), []),
    ("megrez", ("<|role_start|>",), []),
    ("yandex", (" Ассистент:",), []),
    ("bailing", ("<role>ASSISTANT</role>", "'HUMAN'"), []),
    ("llama4", ("<|header_start|>", "<|header_end|>"), []),
    ("dots1", ("<|endofuserprompt|>",), []),
]
UNKNOWN = "unknown"


def detect_chat_template(text) -> Column:
    """Family of a template text; an exact family name wins."""
    c = F.col(text) if isinstance(text, str) else text
    has = lambda needle: F.contains(c, F.lit(needle))
    out = F.when(c.isin(*NAMED), c)
    for name, needles, groups in LADDER:
        cond = F.lit(True)
        for n in needles:
            # a text that starts with this name counts as having the instruction mark
            cond = cond & ((has(n) | F.startswith(c, F.lit("mistral"))) if n == "[INST]" else has(n))
        if groups:
            options = F.lit(False)
            for g in groups:
                inner = F.lit(True)
                for n in g:
                    inner = inner & has(n)
                options = options | inner
            cond = cond & options
        out = out.when(cond, F.lit(name))
    return out.otherwise(UNKNOWN)
