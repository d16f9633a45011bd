"""Source queries: rows of the given tables are written in a format and read back by the source under test."""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.catalog.base import query
from loomspark.catalog.bench_queries import bench_rows
from loomspark.catalog.inputs import IDS, doc_ids
from loomspark.catalog.prep_queries import INSTR, instructions
from loomspark.operators import ngrams as ng
from loomspark.operators import vectors as V
from loomspark.plans.bounds import dealt
from loomspark.plans.scratch import fresh_folder
from loomspark.sources import binary_files as bf
from loomspark.sources import text_files as tf
from loomspark.sources.ranges import write_bytes, write_files
from loomspark.sources.tensor_files import read_tensor_file


def folder(t, what):
    return fresh_folder(t.spark, what)


def name_of(path):
    return F.element_at(F.split(path, "/"), -1).alias(path)


@query("s1_instructions", f"WITH {INSTR} SELECT instruction, md5(input) AS input, nullif(output, '') AS output, count(*) AS n FROM ins GROUP BY ALL")
def _(t):
    path = folder(t, "instructions")
    instructions(t).drop("doc_id").write.json(path)
    rows = tf.read_instructions(t.spark, path, "jsonl")
    return rows.groupBy("instruction", F.md5("input").alias("input"), "output").agg(F.count("*").alias("n"))


@query("s2_texts", "SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    path = folder(t, "texts")
    t.documents.select("text").write.json(path)
    return tf.read_texts(t.spark, path, "jsonl").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("n"))


@query(
    "s3_split_records",
    "SELECT doc_id, (i - 1)::INTEGER AS record_no, md5(r) AS digest FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS r, generate_subscripts(string_split(text, '. '), 1) AS i FROM documents)",
)
def _(t):
    return tf.split_records(t.documents, "text", ". ", keep=["doc_id"]).select("doc_id", "record_no", F.md5("record").alias("digest"))


@query(
    "s4_quiz6",
    "SELECT o_orderkey AS task, 'order ' || o_orderkey AS context, (o_custkey % 4)::INTEGER AS gold, 'a' || o_custkey || ',b,c,d' AS endings FROM orders",
)
def _(t):
    path = folder(t, "quiz")
    lines = F.concat_ws("\n", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), (F.col("o_custkey") % 4).cast("string"), F.concat(F.lit("a"), F.col("o_custkey").cast("string")), F.lit("b"), F.lit("c"), F.lit("d"))
    t.orders.select(lines.alias("value")).write.text(path)
    rows = tf.read_quiz6(t.spark, path)
    return rows.select(F.substring("context", 7, 20).cast("long").alias("task"), "context", "gold", F.array_join("endings", ",").alias("endings"))


@query(
    "s5_blank_csv",
    "SELECT o_orderkey::VARCHAR AS idx, 'The cat, no ' || o_orderkey || ' sat on ' AS first, ' again_' AS second, 'mat' AS choice1, 'hat' AS choice2, (o_custkey % 2 + 1)::INTEGER AS answer FROM orders WHERE o_orderkey % 5 < 2",
)
def _(t):
    path = folder(t, "blanks")
    k, c = F.col("o_orderkey").cast("string"), (F.col("o_custkey") % 2 + 1).cast("string")
    good = F.concat(k, F.lit(',"The cat, no '), k, F.lit(' sat on _ again_",mat,hat,'), c)
    kind = F.col("o_orderkey") % 5
    line = F.when(kind < 2, good).when(kind == 2, F.concat(k, F.lit(",no mark here,mat,hat,1"))).when(kind == 3, F.concat(k, F.lit(",a _ b,mat,hat,3"))).otherwise(F.concat(k, F.lit(",too few")))
    t.orders.select(line.alias("value")).write.text(path)
    return tf.read_blank_csv(t.spark, path)


@F.pandas_udf(T.BinaryType())
def _choice_file(keys: pd.Series, names: pd.Series) -> pd.Series:
    def text(s):
        return struct.pack("<I", len(s.encode())) + s.encode()

    def one(k, name):
        answers = struct.pack("<I", 2) + text(f"yes {k}") + text("no") + struct.pack("<2i", 1, 0)
        return struct.pack("<II", 1, 8) + text(name) + answers + answers

    return pd.Series([one(k, n) for k, n in zip(keys, names)])


@query(
    "s6_choice_files",
    "SELECT c_custkey::VARCHAR AS path, 0::BIGINT AS task, c_name AS question, mode, a::INTEGER AS answer_no, CASE a WHEN 0 THEN 'yes ' || c_custkey ELSE 'no' END AS answer, (1 - a)::INTEGER AS label FROM customer, (SELECT unnest(['single', 'multi']) AS mode), unnest(range(2)) AS r(a)",
)
def _(t):
    files = t.customer.select(F.col("c_custkey").cast("string").alias("path"), _choice_file("c_custkey", "c_name").alias("content"))
    return bf.read_choice_bin(t.spark, write_files(files, folder(t, "choices"))).select(name_of("path"), "task", "question", "mode", "answer_no", "answer", "label")


@F.pandas_udf(T.BinaryType())
def _logits_file(keys: pd.Series) -> pd.Series:
    """Two chunks of eight positions over a vocabulary of five."""

    def one(k):
        n_ctx, n_vocab, n_chunk = 8, 5, 2
        tokens = (k + np.arange(n_ctx * n_chunk)) % n_vocab
        rows = b""
        for r in range((n_ctx - 1 - n_ctx // 2) * n_chunk):
            q = ((k + r * 7 + np.arange(6) * 11) % 1000).astype("<u2")
            rows += struct.pack("<2f", 0.5, -(k % 8)) + q.tobytes()
        return b"_logits_" + struct.pack("<Iii", n_ctx, n_vocab, n_chunk) + tokens.astype("<i4").tobytes() + rows

    return keys.map(one)


@query(
    "s7_logit_files",
    """WITH r AS (SELECT s_suppkey AS k, c AS chunk, p AS pos FROM supplier, unnest(range(2)) AS a(c), unnest(range(4, 7)) AS b(p))
SELECT k::VARCHAR AS path, chunk, pos::INTEGER AS pos, ((k + chunk * 8 + pos + 1) % 5)::INTEGER AS target, 0.5::DOUBLE AS scale, (0 - k % 8)::DOUBLE AS min_log_prob,
 array_to_string(list_transform(range(5), lambda i: (k + (chunk * 3 + pos - 4) * 7 + i * 11) % 1000), ',') AS q FROM r""",
)
def _(t):
    files = t.supplier.select(F.col("s_suppkey").cast("string").alias("path"), _logits_file("s_suppkey").alias("content"))
    rows = bf.read_logits(t.spark, write_files(files, folder(t, "logits")), chunks_per_task=1)
    return rows.select(name_of("path"), "chunk", "pos", "target", F.col("scale").cast("double").alias("scale"), (F.col("min_log_prob").cast("double") + F.lit(0.0)).alias("min_log_prob"), F.array_join(F.col("q").cast("array<string>"), ",").alias("q"))


@F.pandas_udf(T.BinaryType())
def _importance_file(keys: pd.Series) -> pd.Series:
    def one(k):
        name = f"blk.{k}.w".encode()
        body = struct.pack("<i", len(name)) + name + struct.pack("<ii", k % 5 + 1, 3) + struct.pack("<3f", k, k + 0.5, k * 2)
        return struct.pack("<i", 1) + body + struct.pack("<ii", 1, 0)

    return keys.map(one)


@query(
    "s9_importance_files",
    "SELECT s_suppkey::VARCHAR AS path, 'blk.' || s_suppkey || '.w' AS tensor, c::INTEGER AS col, [s_suppkey, s_suppkey + 0.5, s_suppkey * 2][c + 1]::DOUBLE AS value, s_suppkey % 5 + 1 AS cnt, s_suppkey % 5 + 1 AS ncall FROM supplier, unnest(range(3)) AS r(c)",
)
def _(t):
    files = t.supplier.select(F.col("s_suppkey").cast("string").alias("path"), _importance_file("s_suppkey").alias("content"))
    return bf.read_importance(t.spark, write_files(files, folder(t, "importance"))).withColumn("path", name_of("path"))


@F.pandas_udf(T.BinaryType())
def _ngram_file(entries: pd.Series) -> pd.Series:
    def one(rows):
        out = b""
        for r in rows:
            gram = list(r["ngram"]) + [-1] * (4 - len(r["ngram"]))
            out += struct.pack("<4i", *gram) + struct.pack("<3i", 1, r["token"], r["cnt"])
        return out

    return entries.map(one)


#: Documents that a task counts and writes, about.
FILE_DOCS = 2_000


@query(
    "s10_ngram_files",
    f"WITH {IDS}, w AS (SELECT doc_id, lag(token_id, 2) OVER o AS a, lag(token_id) OVER o AS b, token_id FROM ids WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) SELECT 2::INTEGER AS n, a || ' ' || b AS ngram, token_id AS token, count(*) AS cnt FROM w WHERE a IS NOT NULL GROUP BY ALL",
)
def _(t):
    """Counts go through one file per document and are merged again.

    Documents are dealt out once, as ids; a task counts its own and writes their files.
    """
    counts = ng.ngram_counts(dealt(doc_ids(t), "doc_id", rows=FILE_DOCS), 2, 2, keep=("doc_id",))
    entry = F.struct("ngram", "token", F.col("cnt").cast("int").alias("cnt"))
    files = counts.groupBy("doc_id").agg(F.collect_list(entry).alias("e")).select(F.col("doc_id").cast("string").alias("path"), _ngram_file("e").alias("content"))
    merged = ng.ngram_merge(bf.read_ngrams(t.spark, write_files(files, folder(t, "ngrams")), range_bytes=1 << 12))
    return merged.select("n", F.array_join(F.col("ngram").cast("array<string>"), " ").alias("ngram"), "token", "cnt")


BACK = """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'abcd1234' ELSE 'ef5678901' END AS build_commit, (l_suppkey % 3) * 128 AS n_ubatch, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE '0.00' END AS tensor_split, round(sum(l_quantity), 6) AS total, count(*) AS n FROM lineitem GROUP BY 1, 2, 3"""


def bench_back(rows):
    return rows.groupBy("build_commit", "n_ubatch", "tensor_split").agg(F.round(F.sum("avg_ts"), 6).alias("total"), F.count("*").alias("n"))


@query("s11_s12_bench_jsonl", BACK)
def _(t):
    path = folder(t, "bench")
    tf.write_bench(bench_rows(t), path, "jsonl")
    return bench_back(tf.read_bench(t.spark, path, "jsonl"))


@query("s11_s12_bench_csv", BACK)
def _(t):
    path = folder(t, "bench")
    tf.write_bench(bench_rows(t), path, "csv")
    return bench_back(tf.read_bench(t.spark, path, "csv"))


@query(
    "s13_transcripts",
    "SELECT (c_custkey // 64)::VARCHAR AS model, c_custkey % 64 + 1 AS question_no, 'answer ' || c_custkey || chr(10) || c_name AS answer, 'q' || (c_custkey % 64 + 1) AS question FROM customer",
)
def _(t):
    """One transcript for each block of 64 customers."""
    path = folder(t, "transcripts")
    key = F.col("c_custkey")
    body = F.concat(F.lit("answer "), key.cast("string"), F.lit("\n"), "c_name", F.lit("\n------"))
    blocks = t.customer.select(F.floor(key / 64).alias("m"), key, body.alias("value"))
    blocks.repartition("m").sortWithinPartitions("m", "c_custkey").select("m", "value").write.partitionBy("m").text(path)
    sheet = t.customer.select((key % 64 + 1).alias("question_no")).distinct().withColumn("question", F.concat(F.lit("q"), F.col("question_no").cast("string")))
    return tf.read_transcripts(t.spark, path, sheet, model_pattern=r"/m=(\d+)/")


@query("s14_checksums", "SELECT sha256(html) AS hash, 'page ' || page_id || '.html' AS filename FROM pages")
def _(t):
    path = folder(t, "sums")
    t.pages.select(F.concat(F.sha2("html", 256), F.lit("  page "), F.col("page_id").cast("string"), F.lit(".html")).alias("value")).write.text(path)
    return tf.read_checksums(t.spark, path)


@query("s14_manifest", "SELECT 'sha1' AS kind, sha1(html) AS hash, 'f.bin' AS file, 'page_' || page_id AS tensor FROM pages")
def _(t):
    path = folder(t, "manifest")
    t.pages.select(F.concat(F.lit("sha1    "), F.sha1("html"), F.lit("  f.bin:page_"), F.col("page_id").cast("string")).alias("value")).write.text(path)
    return tf.read_manifest(t.spark, path).select("kind", "hash", "file", "tensor")


@query(
    "s15_tool_bench",
    "SELECT 'm' || user_id % 3 AS model, event_type AS test, count(*) AS n, round(sum(value), 6) AS total FROM events WHERE event_id % 4 = 0 GROUP BY 1, 2",
)
def _(t):
    path = folder(t, "tools")
    full = F.to_json(F.struct(F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"), F.lit("s").alias("server_name"), F.col("event_type").alias("test"), F.col("value").alias("success_ratio"), F.lit(1).alias("success_count"), F.lit(0).alias("failure_count")))
    k = F.col("event_id") % 4
    line = F.when(k == 0, full).when(k == 1, "{broken").when(k == 2, "   ").otherwise('{"model": "x"}')
    t.events.select(line.alias("value")).write.text(path)
    rows, _ = tf.read_tool_bench(t.spark, path)
    return rows.groupBy("model", "test").agg(F.count("*").alias("n"), F.round(F.sum("success_ratio"), 6).alias("total"))


@query("s16_pages_to_text")
def _(t):
    out = tf.pages_to_text(t.pages)
    return out.select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@query(
    "s17_embedding_objects",
    "SELECT vec_id, label, len(embedding)::INTEGER AS n, true AS exact FROM embeddings",
)
def _(t):
    """Base64 of float32 bytes decodes to the vector again."""
    rows = V.embedding_objects(t.embeddings, key="vec_id", vec="embedding", base64=True)
    raw = F.unbase64(F.get_json_object("value", "$.embedding"))
    back = rows.select("vec_id", _floats(raw).alias("back"))
    both = back.join(t.embeddings, "vec_id")
    return both.select("vec_id", "label", F.size("back").alias("n"), (F.col("back") == F.col("embedding")).alias("exact"))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _floats(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: np.frombuffer(b, "<f4"))


@query(
    "s18_weight_map",
    "SELECT 't' || p_partkey AS tensor, CASE WHEN p_partkey % 10 = 0 THEN 'missing' ELSE 'extra' END AS problem, CASE WHEN p_partkey % 10 = 0 THEN 'file-' || p_partkey % 4 END AS file FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 10 = 7",
)
def _(t):
    name = F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("tensor")
    index = t.part.filter("p_partkey % 10 <> 7").select(name, F.concat(F.lit("file-"), (F.col("p_partkey") % 4).cast("string")).alias("file"))
    return tf.check_weight_map(index, t.part.filter("p_partkey % 10 <> 0").select(name))


@query("s19_sharegpt", "SELECT conv_id::VARCHAR AS id, turn::INTEGER AS turn, CASE role WHEN 'user' THEN 'human' ELSE role END AS \"from\", md5(text) AS digest FROM conversations")
def _(t):
    path = folder(t, "chats")
    who = F.when(F.col("role") == "user", "human").otherwise(F.col("role"))
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", who.alias("from"), F.col("text").alias("value")))).alias("c"))
    body = F.transform("c", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    turns.select(F.col("conv_id").cast("string").alias("id"), body.alias("conversations")).write.json(path)
    rows = tf.read_sharegpt(t.spark, path, "jsonl")
    return rows.select("id", "turn", "from", F.md5("value").alias("digest"))


@query("s20_prompt_pairs", "SELECT (s_suppkey // 16)::VARCHAR AS grp, s_suppkey % 16 AS pair, 'good ' || s_name AS positive, 'bad ' || s_name AS negative FROM supplier")
def _(t):
    """A pair of files for each block of 16 suppliers, with a blank line behind every prompt."""
    path = folder(t, "pairs")
    for side in ("good", "bad"):
        lines = t.supplier.select(F.floor(F.col("s_suppkey") / 16).alias("m"), "s_suppkey", F.concat(F.lit(f"{side} "), "s_name", F.lit("\n")).alias("value"))
        lines.repartition("m").sortWithinPartitions("m", "s_suppkey").select("m", "value").write.partitionBy("m").text(f"{path}/{side}")
    return tf.read_prompt_pairs(t.spark, f"{path}/good", f"{path}/bad", group_pattern=r"/m=(\d+)/")


@F.pandas_udf(T.StringType())
def _tensor_file(paths: pd.Series, names: pd.Series, rows: pd.Series) -> pd.Series:
    """Write one tensor file per row: two metadata keys and a float tensor per entry."""

    def text(s):
        return struct.pack("<Q", len(s.encode())) + s.encode()

    def one(path, name, entries):
        head = struct.pack("<IIQQ", 0x46554747, 3, len(entries), 2)
        head += text("general.name") + struct.pack("<I", 8) + text(name)
        head += text("sizes") + struct.pack("<IIQ", 9, 4, len(entries)) + struct.pack(f"<{len(entries)}I", *[e["size"] for e in entries])
        at = 0
        for e in entries:
            head += text(e["tensor"]) + struct.pack("<IQQIQ", 2, e["size"], 2, 0, at)
            at += -(-8 * e["size"] // 32) * 32
        body = b"".join((np.arange(2 * e["size"], dtype="<f4") + e["size"]).tobytes().ljust(-(-8 * e["size"] // 32) * 32, b"\0") for e in entries)
        write_bytes(path, head.ljust(-(-len(head) // 32) * 32, b"\0") + body)
        return path

    return pd.Series([one(p, n, r) for p, n, r in zip(paths, names, rows)])


TENSOR_FILES = "f AS (SELECT p_partkey // 64 AS k, p_partkey % 64 AS idx, 't' || p_partkey AS tensor, p_size AS size FROM part)"


def tensor_folder(t):
    """Files of up to 64 tensors each, in a folder every worker sees."""
    where = folder(t, "tensors")
    k = F.floor(F.col("p_partkey") / 64)
    entry = F.struct((F.col("p_partkey") % 64).alias("idx"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("tensor"), F.col("p_size").alias("size"))
    files = t.part.groupBy(k.alias("k")).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    path = F.concat(F.lit(f"{where}/"), F.col("k").cast("string"), F.lit(".gguf"))
    files.select(_tensor_file(path, F.concat(F.lit("model "), F.col("k").cast("string")), "rows").alias("path")).write.format("noop").mode("overwrite").save()
    return f"{where}/*.gguf"


def file_key():
    return F.regexp_extract("file", r"(\d+)\.gguf$", 1).cast("long").alias("k")


@query("s8_tensor_list", f"WITH {TENSOR_FILES} SELECT k, idx, tensor, 'F32' AS type, '2x' || size AS shape, size::BIGINT * 2 AS n_elements, size::BIGINT * 8 AS n_bytes FROM f")
def _(t):
    rows = read_tensor_file(t.spark, tensor_folder(t), "tensors")
    return rows.select(file_key(), "idx", "tensor", "type", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), "n_elements", "n_bytes")


@query(
    "s8_metadata",
    f"WITH {TENSOR_FILES} SELECT DISTINCT k, 0::BIGINT AS idx, 'general.name' AS key, 'STRING' AS type, false AS is_array, 'model ' || k AS value FROM f UNION ALL SELECT k, 1, 'sizes', 'UINT32', true, string_agg(size::VARCHAR, ',' ORDER BY idx) FROM f GROUP BY k",
)
def _(t):
    rows = read_tensor_file(t.spark, tensor_folder(t), "kv")
    return rows.select(file_key(), "idx", "key", "type", "is_array", F.array_join("items", ",").alias("value"))


@query("s8_tensor_data", f"WITH {TENSOR_FILES} SELECT k, idx, tensor, (size * 8)::INTEGER AS n_bytes, (size * 2 * size + size * (size * 2 - 1))::DOUBLE AS total FROM f")
def _(t):
    rows = read_tensor_file(t.spark, tensor_folder(t), "data")
    total = F.aggregate(_floats("data"), F.lit(0.0), lambda s, x: s + x)
    return rows.select(file_key(), "idx", "tensor", F.octet_length("data").alias("n_bytes"), total.alias("total"))
