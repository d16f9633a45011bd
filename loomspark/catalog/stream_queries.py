"""Streaming queries over ``events``, ``documents``, ``conversations`` and ``lineitem``, and user-function queries."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.inputs import DOCS, doc_words
from loomspark.catalog.metric_queries import LP
from loomspark.functions import text
from loomspark.operators import hooks as H
from loomspark.operators.metrics import log_softmax
from loomspark.plans.bounds import spread
from loomspark.plans.scratch import fresh_folder
from loomspark.streaming import jobs as J

LATE = "10 minutes"


def events(t):
    rows = J.table_stream(t.spark, t.root, "events")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def steps(rows):
    return rows.select(
        "ts", "event_type", (F.col("event_id") % 500).alias("prompt_n"), F.col("value").alias("prompt_ms"), F.col("user_id").alias("predicted_n"), (F.col("value") * 2).alias("predicted_ms"), (F.col("user_id") % 8).alias("busy_slots"), F.lit(1).cast("bigint").alias("steps")
    )


BATCHES = 6
DAY = "2024-01-01 00:00:00"


def in_batches(t, rows, batch, what):
    """The rows as files of a folder, one for each of ``BATCHES`` and a last one far behind them in time, in two parts.

    ``batch`` says in which file a row is; ``ts`` is a minute for each.  The file behind them moves the watermark on, so
    that states become idle.
    """
    path = fresh_folder(t.spark, what)
    minute = F.lit(DAY).cast("timestamp") + F.make_interval(mins=F.col("batch"))
    timed = rows.withColumn("batch", batch.cast("int")).withColumn("ts", minute)
    schema = timed.drop("batch").schema
    staged = fresh_folder(t.spark, f"{what}-staged")  # computed once, by all tasks
    timed.write.partitionBy("batch").parquet(staged)
    timed = t.spark.read.schema(timed.schema).parquet(staged)

    def write(first, last):
        for k in range(first, last):  # in the order in which they are read
            timed.filter(F.col("batch") == k).drop("batch").coalesce(1).write.mode("append").parquet(path)

    def heartbeat(hours):
        empty = {f.name: F.lit(None).cast(f.dataType) for f in schema}
        late = t.spark.range(1).select(*[F.lit(-hours).cast("long").alias(c) if c.endswith("_id") else F.lit(0).cast("long").alias(c) if c == "seq" else (F.lit(DAY).cast("timestamp") + F.make_interval(hours=F.lit(hours))).alias(c) if c == "ts" else empty[c].alias(c) for c in schema.names])
        late.coalesce(1).write.mode("append").parquet(path)

    return path, schema, write, heartbeat


def run_twice(t, job, path, schema, write, heartbeat, what, progress=None):
    """Run over the first half of the batches, then go on from the checkpoint with the rest and what makes the states idle."""
    out = fresh_folder(t.spark, what)
    stream = lambda: job(J.folder_stream(t.spark, path, schema))
    write(0, BATCHES // 2)
    J.run_to_table(stream(), what, out, progress)
    write(BATCHES // 2, BATCHES)
    for hours in (10, 20):
        heartbeat(hours)
    return J.run_to_table(stream(), what, out, progress)


def word_chunks(t):
    words = t.documents.select("doc_id", text.words("text").alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1)), F.lit(200))
    chunks = words.select("doc_id", F.posexplode(F.transform(starts, lambda i: F.slice("w", i, F.lit(200)))).alias("seq", "tokens"))
    return chunks.withColumn("seq", F.col("seq").cast("long"))


def word_deltas(t):
    # The words in a column of their own: as an expression they would be split again for each word.
    parts = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("reply_id"), F.split("text", r"(?<= )", -1).alias("parts"))
    rows = parts.select("reply_id", F.size("parts").alias("n"), F.posexplode("parts").alias("seq", "delta"))
    return rows.select("reply_id", F.col("seq").cast("long").alias("seq"), "delta", (F.col("seq") == F.col("n") - 1).alias("last"), "n")


def chunk_job(t, progress=None):
    """Chunk 0 in the first file, chunk 1 in the second, and so on; the last file has the rest."""
    parts = in_batches(t, word_chunks(t), F.least(F.col("seq"), F.lit(BATCHES - 1)), "chunks")
    return run_twice(t, lambda s: J.incremental_ngrams(s, 2, 2, ts="ts"), *parts, "ngrams", progress)


def delta_job(t, progress=None):
    """The words of a message in six files; one word of each third message comes a file later than its turn, as far as there is one."""
    rows = word_deltas(t)
    own = F.least(F.floor(F.col("seq") * BATCHES / F.greatest(F.col("n"), F.lit(1))), F.lit(BATCHES - 1))
    late = (F.col("reply_id") % 3 == 0) & (F.col("seq") == 1)
    batch = F.when(late, F.least(own + 1, F.lit(BATCHES - 1))).otherwise(own)
    parts = in_batches(t, rows, batch, "deltas")
    return run_twice(t, lambda s: J.assemble_replies(s, [" the "], ts="ts"), *parts, "replies", progress)


@query(
    "x1_incremental_ngrams",
    f"""WITH {DOCS}, g AS (SELECT unnest(list_transform(range(1, greatest(len(toks) - 1, 1)), lambda i: {{'ngram': toks[i] || ' ' || toks[i + 1], 'token': toks[i + 2]}})) AS g FROM docs)
SELECT g.ngram AS ngram, g.token AS token, count(*) AS cnt FROM g GROUP BY ALL""",
)
def _(t):
    """Documents arrive in chunks of 200 words, in six files and two runs; the streamed counts equal the batch counts."""
    out = chunk_job(t)
    return out.filter("n > 0").groupBy(F.array_join("ngram", " ").alias("ngram"), "token").agg(F.sum("cnt").alias("cnt"))


@query(
    "x2_assembled_replies",
    "SELECT conv_id * 1000 + turn AS reply_id, md5(split_part(text, ' the ', 1)) AS digest FROM conversations",
)
def _(t):
    """Messages arrive word by word, in six files and two runs, some words late; a reply ends in front of the stop text."""
    out = delta_job(t).filter("reply_id >= 0")
    whole = out.groupBy("reply_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("p"))
    return whole.select("reply_id", F.md5(F.array_join(F.transform("p", lambda x: x["text"]), "")).alias("digest"))


@query("x2_state_goes", "SELECT true AS many_batches, true AS held_all, true AS fell, true AS all_closed, count(*) AS n FROM conversations")
def _(t):
    """State while messages come and when they have been idle: rows fall to those of what came last."""
    progress: list = []
    out = delta_job(t, progress).filter("reply_id >= 0")
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    n = out.filter("done").select("reply_id").distinct().count()
    facts = out.filter("done").groupBy("reply_id").agg(F.count("*").alias("times")).agg(F.count("*").alias("n"), F.bool_and(F.col("times") == 1).alias("all_closed"))
    return facts.select(F.lit(len(rows) >= BATCHES + 2).alias("many_batches"), F.lit(max(rows) >= n).alias("held_all"), F.lit(rows[-1] <= 6).alias("fell"), "all_closed", "n")


@query(
    "x3_service_buckets",
    """WITH b AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS start, sum(event_id % 500)::BIGINT AS pn, sum(value) AS pm, sum(user_id)::BIGINT AS gn, count(*) AS steps FROM events GROUP BY 1)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, pn AS prompt_tokens_total, gn AS tokens_predicted_total, steps AS n_decode_total, round(1000 * pn / pm, 6) AS prompt_tokens_seconds FROM b WHERE start + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)""",
)
def _(t):
    out = J.run_to_table(J.service_buckets(steps(events(t)), "1 hour", LATE), "buckets")
    return out.select(F.date_format("bucket.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "prompt_tokens_total", "tokens_predicted_total", "n_decode_total", F.round("prompt_tokens_seconds", 6).alias("prompt_tokens_seconds"))


@query(
    "x3_service_totals",
    "SELECT sum(event_id % 500)::BIGINT AS prompt_tokens_total, sum(user_id)::BIGINT AS tokens_predicted_total, count(*) AS n_decode_total, round(sum(value) / 1000, 6) AS prompt_seconds_total FROM events",
)
def _(t):
    out = J.latest(J.run_snapshots(J.service_totals(steps(events(t))), "totals"))
    return out.select("prompt_tokens_total", "tokens_predicted_total", "n_decode_total", F.round("prompt_seconds_total", 6).alias("prompt_seconds_total"))


@query(
    "x4_metric_series",
    """SELECT event_type, strftime(time_bucket(INTERVAL '2 seconds', ts), '%Y-%m-%d %H:%M:%S') AS start, round(avg(value), 6) AS value FROM events
WHERE time_bucket(INTERVAL '2 seconds', ts) + INTERVAL '2 seconds' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events) GROUP BY 1, time_bucket(INTERVAL '2 seconds', ts)""",
)
def _(t):
    out = J.run_to_table(J.metric_stream(events(t), "2 seconds", LATE, keys=("event_type",)), "series")
    return out.select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("value", 6).alias("value"))


@query(
    "x5_running_importance",
    "SELECT 'blk.' || l_suppkey % 5 AS tensor, (l_partkey % 2)::INTEGER AS expert, l_linenumber AS col, round(sum(l_quantity / 50 * (l_quantity / 50)), 6) AS sum_sq, count(*) AS cnt FROM lineitem GROUP BY 1, 2, 3",
)
def _(t):
    rows = J.table_stream(t.spark, t.root, "lineitem").select(
        F.concat(F.lit("blk."), (F.col("l_suppkey") % 5).cast("string")).alias("tensor"), (F.col("l_partkey") % 2).cast("int").alias("expert"), F.col("l_linenumber").alias("col"), (F.col("l_quantity") / 50).alias("x")
    )
    return J.latest(J.run_snapshots(J.running_importance(rows), "importance")).withColumn("sum_sq", F.round("sum_sq", 6))


@query(
    "x6_running_perplexity",
    f"""WITH {LP}, a AS (SELECT chunk, sum(nll) AS s, sum(nll * nll) AS s2, count(*) AS n FROM nll GROUP BY 1)
SELECT chunk, n, round(exp(s / n), 6) AS ppl, round(exp(s / n) * sqrt(greatest(s2 / n - (s / n) * (s / n), 0) / (n - 1)), 6) AS err FROM a""",
)
def _(t):
    salt = 1299709
    logits = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: ((F.col("event_id") * 7919 + i.cast("long") * salt) % 1000) / F.lit(100.0) - 5)
    rows = events(t).select(F.col("user_id").alias("chunk"), (F.floor(F.col("value") * 100) % 16).cast("int").alias("target"), logits.alias("logits"))
    scored = log_softmax(rows).withColumn("correct", F.get("logits", F.col("target")) == F.array_max("logits"))
    out = J.latest(J.run_snapshots(J.running_loss(scored, "chunk"), "loss", J.close_loss))
    return out.select("chunk", "n", F.round("ppl", 6).alias("ppl"), F.round("err", 6).alias("err"))


@query(
    "x7_truncation_alerts",
    """WITH b AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS start, avg((event_type = 'click')::INTEGER) AS rate, count(*) AS n FROM events GROUP BY 1)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, round(rate, 9) AS rate, n FROM b WHERE rate >= 0.8 AND start + INTERVAL '1 minute' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events) AND start >= TIMESTAMP '2024-01-01 00:01:00'""",
)
def _(t):
    rows = events(t).withColumn("finish", F.when(F.col("event_type") == "click", "length").otherwise("stop"))
    since = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    out = J.run_to_table(J.truncation_alerts(rows, "1 minute", LATE, since=since), "alerts")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("rate", 9).alias("rate"), "n")


@query(
    "x9_distinct_failures",
    "SELECT DISTINCT 'm' || user_id % 3 AS model, event_type AS test, 'failure ' || event_id % 4 AS error FROM events",
)
def _(t):
    rows = events(t).select("ts", F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"), F.col("event_type").alias("test"), F.concat(F.lit("failure "), (F.col("event_id") % 4).cast("string")).alias("error"))
    out = J.run_to_table(J.distinct_failures(rows, "40 days"), "failures")
    return out.select("model", "test", "error")


# ------------------------------------------------------------------ user functions


@query("u1_map_batches", "SELECT doc_id, length('Q: ' || text || ' A: ' || lang)::BIGINT AS n FROM documents")
def _(t):
    rows = spread(t.documents.select("doc_id", "text", "lang"), "doc_id")
    fmt = lambda b: {"doc_id": b["doc_id"], "n": [len(f"Q: {x} A: {y}") for x, y in zip(b["text"], b["lang"])]}
    return H.map_batches(rows, fmt, "doc_id long, n long")


@query(
    "u4_score_with",
    f"WITH {DOCS} SELECT doc_id, md5(array_to_string(list_reverse(toks)[:1200], ' ')) AS digest FROM docs",
)
def _(t):
    rows = spread(t.documents.select("doc_id", "text"), "doc_id")
    return H.score_with(rows, H.toy_generator, "string", key="doc_id", text="text").select("doc_id", F.md5("reply").alias("digest"))


@query("u5_embed_with", f"WITH {DOCS} SELECT doc_id, 16::INTEGER AS width, CASE WHEN len(toks) = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS norm FROM docs")
def _(t):
    out = H.embed_with(doc_words(t), H.toy_embedder, 4096, key="doc_id")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    return out.select("doc_id", F.size("vec").alias("width"), F.round(norm, 9).alias("norm"))


@query(
    "u6_table_function",
    f"""WITH {DOCS}, s AS (SELECT doc_id, toks, unnest(range(0, greatest(len(toks) - 64, 0) + 1, 32)) AS start FROM docs)
SELECT doc_id, (start // 32)::INTEGER AS window_no, start::INTEGER AS start, md5(array_to_string(toks[start + 1:start + 64], ' ')) AS digest FROM s""",
)
def _(t):
    H.register_table_functions(t.spark)
    spread(t.documents.select("doc_id", "text"), "doc_id").createOrReplaceTempView("loomspark_docs")
    out = t.spark.sql("SELECT doc_id, w.* FROM loomspark_docs, LATERAL text_windows(text, 64, 32) AS w")
    return out.select("doc_id", "window_no", "start", F.md5("piece").alias("digest"))
