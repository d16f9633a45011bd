"""Training-row preparation: prompts, API messages, selection, splits and batches."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import rough_pieces, split_keep_empty
from loomspark.plans.prefix import WIDTH, running_sums

# Prompt texts: fixed values, with the blanks their lines start with.
ALPACA = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "    ### Instruction:\n    {instruction}\n\n    ### Input:\n    {input}\n\n    ### Response:\n    {output}"
)
_PAD = " " * 28
REASONING = (
    "以下是描述任务的指令，以及提供更多上下文的输入。\n"
    f"{_PAD}请写出恰当完成该请求的回答。\n"
    f"{_PAD}在回答之前，请仔细思考问题，并创建一个逐步的思维链，以确保回答合乎逻辑且准确。\n"
    "\n"
    f"{_PAD}### Instruction:\n"
    f"{_PAD}你是一位在网络安全、网络攻防、信息保护和安全架构设计方面具有专业知识的网络安全专家。\n"
    f"{_PAD}请回答以下网络安全相关问题。\n"
    "\n"
    f"{_PAD}### Question:\n"
    f"{_PAD}{{instruction}}\n"
    "\n"
    f"{_PAD}### Response:\n"
    f"{_PAD}<think>\n"
    f"{_PAD}{{thought}}\n"
    f"{_PAD}</think>\n"
    f"{_PAD}{{output}}"
)


def fill(template: str, **slots) -> Column:
    """A template with its ``{name}`` slots replaced by columns; null counts as empty."""
    parts = re.split(r"\{(\w+)\}", template)
    cols = []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            cols.append(F.lit(part))
        else:
            value = slots.get(part, part)
            cols.append(F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("")))
    return F.concat(*cols)


def format_alpaca(df: DataFrame, eos: str) -> DataFrame:
    """``text`` from instruction, input and output; the end mark is always appended."""
    return df.withColumn("text", F.concat(fill(ALPACA), F.lit(eos)))


def format_reasoning(df: DataFrame, eos: str) -> DataFrame:
    """``text`` from instruction and output around an empty train of thought."""
    return df.withColumn("text", F.concat(fill(REASONING, thought=F.lit("")), F.lit(eos)))


def format_template(df: DataFrame, template: str, *, domain: str = "") -> DataFrame:
    return df.withColumn("text", fill(template, domain=F.lit(domain)))


# ------------------------------------------------------------------ API messages

_TOOL_CALL = "struct<id:string,name:string,arguments:string>"


def parse_messages(df: DataFrame, json_col: str, *, key: str) -> DataFrame:
    """Rows ``(key, msg_no, role, content, content_parts, tool_calls, reasoning_content, tool_name, tool_call_id, error)``.

    ``error`` names the first rule a message breaks; a body that is no array gives one row with an error.
    """
    body = F.try_parse_json(json_col)
    is_array = F.coalesce(F.schema_of_variant(body).startswith("ARRAY"), F.lit(False))
    msgs = F.when(is_array, F.from_json(json_col, "array<variant>"))
    rows = df.select(key, F.posexplode_outer(msgs).alias("msg_no", "m"))
    kind = F.schema_of_variant("m")
    is_obj = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    fields = F.when(is_obj, F.try_variant_get("m", "$", "map<string,variant>"))
    rows = rows.withColumn("f", fields).withColumn("is_obj", is_obj)
    has = lambda name: F.coalesce(F.map_contains_key("f", name), F.lit(False))
    text = lambda name: F.try_variant_get(F.element_at("f", name), "$", "string")
    content_kind = F.schema_of_variant(F.element_at("f", "content"))
    content_is = lambda k: F.coalesce(content_kind.startswith(k), F.lit(False))
    parts = F.when(content_is("ARRAY"), F.try_variant_get(F.element_at("f", "content"), "$", "array<map<string,variant>>"))
    calls = F.when(has("tool_calls"), F.try_variant_get(F.element_at("f", "tool_calls"), "$", "array<map<string,variant>>"))
    rows = rows.withColumn("parts", parts).withColumn("calls", calls)
    word = lambda m, name: F.try_variant_get(F.element_at(m, F.lit(name)), "$", "string")
    fn = lambda c: F.try_variant_get(F.element_at(c, F.lit("function")), "$", "map<string,variant>")
    lacks = lambda arr, name: F.coalesce(F.exists(arr, lambda x: ~F.map_contains_key(x, name)), F.lit(False))
    wrong = lambda arr, want: F.coalesce(F.exists(arr, lambda x: ~word(x, "type").eqNullSafe(F.lit(want))), F.lit(False))
    no_name = F.coalesce(F.exists("calls", lambda c: ~F.coalesce(F.map_contains_key(fn(c), "name"), F.lit(False))), F.lit(False))
    error = (
        F.when(F.col("m").isNull() & F.col("msg_no").isNull(), "expected messages to be an array")
        .when(~F.col("is_obj"), "expected message to be an object")
        .when(~has("role"), "missing role")
        .when(has("content") & lacks("parts", "type"), "missing content part type")
        .when(has("content") & wrong("parts", "text"), "unsupported content part type")
        .when(
            has("content") & ~content_is("STRING") & ~content_is("ARRAY") & ~content_is("VOID"),
            "invalid content type",
        )
        .when(lacks("calls", "type"), "missing tool call type")
        .when(wrong("calls", "function"), "unsupported tool call type")
        .when(lacks("calls", "function"), "missing tool call function")
        .when(no_name, "missing tool call name")
        .when(~has("content") & ~has("tool_calls"), "expected content or tool_calls")
    )
    call = lambda c: F.struct(
        word(c, "id").alias("id"), word(fn(c), "name").alias("name"), word(fn(c), "arguments").alias("arguments")
    )
    return rows.select(
        key,
        "msg_no",
        text("role").alias("role"),
        F.when(content_is("STRING"), text("content")).alias("content"),
        F.transform("parts", lambda p: F.struct(word(p, "type").alias("type"), word(p, "text").alias("text"))).alias("content_parts"),
        F.transform("calls", call).alias("tool_calls"),
        text("reasoning_content").alias("reasoning_content"),
        text("name").alias("tool_name"),
        text("tool_call_id").alias("tool_call_id"),
        error.alias("error"),
    )


def messages_to_json(df: DataFrame, *, join_text: bool = False) -> DataFrame:
    """Add ``message`` (JSON) and ``error``; columns as :func:`parse_messages` gives them."""
    has_text = F.coalesce(F.col("content") != "", F.lit(False))
    has_parts = F.coalesce(F.size("content_parts") > 0, F.lit(False))
    texts = F.transform(F.filter("content_parts", lambda p: p["type"] == "text"), lambda p: p["text"])
    joined = F.to_json(F.struct(F.array_join(texts, "\n").alias("x")))
    plain = F.to_json(F.struct(F.col("content").alias("x")))
    value = lambda j: j.substr(F.lit(6), F.length(j) - 6)  # noqa: E731  the value of {"x":…}
    content = (
        F.when(has_text, value(plain))
        .when(has_parts, value(joined) if join_text else F.to_json("content_parts"))
        .otherwise("null")
    )
    named = lambda name, col: F.when(
        F.coalesce(F.col(col) != "", F.lit(False)), F.concat(F.lit(f',"{name}":'), value(F.to_json(F.struct(F.col(col).alias("x")))))
    ).otherwise("")
    calls = F.transform(
        "tool_calls",
        lambda c: F.struct(
            F.lit("function").alias("type"),
            F.struct(c["name"].alias("name"), c["arguments"].alias("arguments")).alias("function"),
            F.when(c["id"] != "", c["id"]).alias("id"),
        ),
    )
    tool_calls = F.when(F.coalesce(F.size("tool_calls") > 0, F.lit(False)), F.concat(F.lit(',"tool_calls":'), F.to_json(calls))).otherwise("")
    message = F.concat(
        F.lit('{"role":'), value(F.to_json(F.struct(F.col("role").alias("x")))), F.lit(',"content":'), content,
        named("reasoning_content", "reasoning_content"), named("name", "tool_name"), named("tool_call_id", "tool_call_id"), tool_calls, F.lit("}"),
    )
    both = has_text & has_parts
    return df.withColumn("message", F.when(~both, message)).withColumn("message_error", F.when(both, "cannot specify both content and content_parts"))


def _first_keys(keys: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` first rows of a narrow table in ``order``, ranked over all tasks."""
    return running_sums(keys, [], order, {"__i": F.lit(1).cast("long")}, inclusive=False).filter(F.col("__i") < n).drop("__i")


def select_prompts(df: DataFrame, max_prompt: int, max_ctx: int, n: int, *, conv: str = "conv_id") -> DataFrame:
    """The first ``n`` usable prompts of ``(conv, n_turns, first_from, prompt, reply)``."""
    rows = df.filter((F.col("n_turns") >= 2) & (F.col("first_from") == "human"))
    rows = rows.withColumn("n_prompt", rough_pieces("prompt")).withColumn("n_reply", rough_pieces("reply"))
    ok = (F.col("n_prompt") >= 4) & (F.col("n_reply") >= 4) & (F.col("n_prompt") <= max_prompt) & (F.col("n_prompt") + F.col("n_reply") <= max_ctx)
    rows = rows.filter(ok).select(conv, "prompt", "n_prompt", "n_reply")
    return rows.join(_first_keys(rows.select(conv), conv, n), conv, "left_semi")


# ------------------------------------------------------------------ token prompts


def _ids(*ids: int | None) -> Column:
    return F.array(*[F.lit(i) for i in ids if i is not None]).cast("array<int>")


def format_rerank(query, doc, *, bos: int | None, eos: int | None, sep: int | None, add_bos=True, add_eos=True, add_sep=True) -> Column:
    """``[BOS] query [EOS] [SEP] doc [EOS]``; SEP stands in for a missing EOS."""
    end = eos if eos is not None else sep
    q, d = (F.col(c) if isinstance(c, str) else c for c in (query, doc))
    return F.concat(
        _ids(bos if add_bos else None), q, _ids(end if add_eos else None, sep if add_sep else None), d, _ids(end if add_eos else None)
    )


def format_pairs(text, cls_sep: str, eos: str, sep: str) -> Column:
    """Pairs split on a separator text, joined with the end and separator tokens' texts."""
    return F.array_join(split_keep_empty(text, cls_sep), eos + sep)


def format_infill(
    df: DataFrame,
    *,
    n_batch: int,
    n_predict: int,
    n_ctx: int,
    pre: int,
    suf: int,
    mid: int,
    bos: int | None = None,
    rep: int | None = None,
    sep: int | None = None,
    repo_name: Sequence[int] = (),
    file_name: Sequence[int] = (),
    snippet: Sequence[int] = (),
    suffix_first: bool = False,
) -> DataFrame:
    """Add ``tokens`` from token arrays ``prefix``, ``suffix``, ``prompt`` and ``extra array<struct<name, tokens>>``.

    The prefix keeps its end, the suffix its start, and extra context its end, each within its share of the batch.
    """
    chunk = lambda e: F.concat(_ids(sep), e["name"], e["tokens"]) if sep is not None else F.concat(_ids(*snippet), e["tokens"])
    extra = F.concat(
        _ids(rep, *repo_name) if rep is not None else _ids(),
        F.flatten(F.transform("extra", chunk)),
        _ids(sep, *file_name) if sep is not None else _ids(),
    )
    last = lambda a, n: F.when(F.size(a) > n, F.slice(a, F.size(a) - n + 1, F.greatest(n, F.lit(0)))).otherwise(a)
    head = F.concat(_ids(pre), last(F.col("prefix"), F.lit(3 * (n_batch // 4))), F.col("prompt"))
    room = F.greatest(F.lit(0), F.lit(n_batch // 4) - (2 + F.size("prompt")))
    tail = F.concat(_ids(suf), F.slice("suffix", F.lit(1), room))
    one, two = (tail, head) if suffix_first else (head, tail)
    kept = last(extra, F.lit(max(0, n_ctx - n_batch - 2 * n_predict)))
    return df.withColumn("tokens", F.concat(kept, _ids(bos), one, two, _ids(mid)))


# Texts of the needle test: fixed values.
NEEDLE_HEAD = "There is an important info hidden inside a lot of irrelevant text. Find it and memorize them. I will quiz you about the important information there."
NEEDLE_JUNK = " The grass is green. The sky is blue. The sun is yellow. Here we go. There and back again."
NEEDLE_TAIL = " What is the pass key? The pass key is"


def make_needles(ids: DataFrame, n_junk: int, *, pos: int = -1, seed: int = 0, key: Column | None = None, at: Column | None = None) -> DataFrame:
    """``(id, passkey, pos, prompt)`` for each row of ``ids(id)``: a key hidden in front of sentence ``pos``.

    ``pos`` -1 draws the place, and the key is drawn from 1 to 50000, both from a hash of id and seed.
    """
    drawn = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(50_000)) + 1 if key is None else key
    place = at if at is not None else (F.lit(pos) if pos >= 0 else F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(n_junk)))
    rows = ids.select("id", drawn.cast("long").alias("passkey"), place.cast("int").alias("pos"))
    k = F.col("passkey").cast("string")
    needle = F.concat(F.lit(" The pass key is "), k, F.lit(". Remember it. "), k, F.lit(" is the pass key."))
    before = F.repeat(F.lit(NEEDLE_JUNK), F.col("pos"))
    after = F.repeat(F.lit(NEEDLE_JUNK), F.lit(n_junk) - F.col("pos"))
    hidden = F.when((F.col("pos") >= 0) & (F.col("pos") < n_junk), F.concat(before, needle, after)).otherwise(F.repeat(F.lit(NEEDLE_JUNK), F.lit(n_junk)))
    return rows.withColumn("prompt", F.concat(F.lit(NEEDLE_HEAD), hidden, F.lit(NEEDLE_TAIL)))


def truncate_tokens(df: DataFrame, n: int = 2048, *, tokens: str = "tokens") -> DataFrame:
    return df.withColumn(tokens, F.slice(tokens, 1, n))


def sample_tasks(df: DataFrame, n: int, *, key: str, seed: int = 1) -> DataFrame:
    """``n`` rows drawn without replacement; the same rows on every run.  ``key`` tells rows apart."""
    drawn = df.select(key, F.xxhash64(key, F.lit(seed)).alias("__drawn"))
    return df.join(_first_keys(drawn, "__drawn", n), key, "left_semi")


def split_by_position(df: DataFrame, frac: float = 0.95, *, key: str) -> DataFrame:
    """Add ``part``: the first ``floor(n * frac)`` rows by key are for training."""
    n = df.count()
    rows = running_sums(df, [], key, {"__i": F.lit(1).cast("long")}, inclusive=False)
    return rows.withColumn("part", F.when(F.col("__i") < int(n * frac), "train").otherwise("validation")).drop("__i")


def shuffle_shards(df: DataFrame, shard_size: int, *, idx: str = "idx", seed: int = 0, upto: int = -1, draw: Column | None = None) -> DataFrame:
    """Add ``shard``, ``place`` and ``whole``: whole shards of ``shard_size`` rows in a drawn order.

    ``idx`` is dense from 0.  Rows behind the last whole shard are a short one that stays last, with ``whole`` false.  With ``upto`` only shards in front of that row change places; the rest keep theirs.
    ``draw`` may replace the hash of (shard, seed); it is a long of at least 0.
    """
    last = df.agg(F.max(idx)).first()[0]
    n_shards = (last + 1) // shard_size
    moving = n_shards if upto < 0 else upto // shard_size
    shards = df.sparkSession.range(moving).select(F.col("id").alias("shard"))
    h = F.shiftrightunsigned(F.xxhash64("shard", F.lit(seed)), 2) if draw is None else draw
    drawn = shards.withColumn("__h", h)
    span = 1 << 62 if draw is None else max(1, drawn.agg(F.max("__h")).first()[0] or 1)
    width = max(1, span // max(1, moving // WIDTH))
    order = running_sums(drawn, [], "__h", {"place": F.lit(1).cast("long")}, inclusive=False, width=width, tie="shard").select("shard", "place")
    rows = df.withColumn("shard", F.floor(F.col(idx) / shard_size).cast("long")).withColumn("whole", F.col("shard") < n_shards)
    return rows.join(order, "shard", "left").withColumn("place", F.coalesce("place", "shard"))


def assign_batches(df: DataFrame, shards_per_batch: int) -> DataFrame:
    """Add ``batch`` and ``full``: batch b takes the shards at places ``b*k … b*k+k-1``; ``full`` is false in a last batch of fewer whole shards."""
    last = df.agg(F.max(F.when(F.col("whole"), F.col("place")))).first()[0]
    n = 0 if last is None else last + 1
    rows = df.withColumn("batch", F.floor(F.col("place") / shards_per_batch).cast("long"))
    return rows.withColumn("full", F.col("batch") < n // shards_per_batch)


def pad_pairs(df: DataFrame, pad: int, *, a: str = "a", b: str = "b") -> DataFrame:
    """Pad the shorter of two token arrays to the length of the longer."""
    n = F.greatest(F.size(a), F.size(b))
    fill_up = lambda c: F.concat(F.col(c), F.array_repeat(F.lit(pad), n - F.size(c)))
    return df.select(*[x for x in df.columns if x not in (a, b)], fill_up(a).alias(a), fill_up(b).alias(b))


# Code points a file name must not hold: fixed values.
BAD_NAME = r'[\x{00}-\x{1F}\x{7F}-\x{9F}\x{FF0E}\x{2215}\x{2216}\x{D800}-\x{DFFF}\x{FFFD}\x{FEFF}/\\:*?"<>|]'


def valid_file_name(name) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    ok = (
        (F.octet_length(c) > 0)
        & (F.octet_length(c) <= 255)
        & F.is_valid_utf8(c)
        & ~c.rlike(BAD_NAME)
        & ~c.rlike(r"^ |[ .]$")
        & ~F.contains(c, F.lit(".."))
    )
    return F.coalesce(ok, F.lit(False))
