"""Inputs derived from the given tables, the same way in Spark and in SQL.

The SQL constants are CTE bodies for the DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text
from loomspark.plans.bounds import dealt, spread

# documents as token arrays
DOCS = r"docs AS (SELECT doc_id, source, lang, text, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS toks FROM documents)"
TOKS = DOCS + r", tk AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS pos FROM docs)"
IDS = TOKS + r", ids AS (SELECT doc_id, pos, ((ascii(tok) * 31 + length(tok)) % 97)::INTEGER AS token_id FROM tk)"
CORPUS = IDS + r", corpus AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos, token_id FROM ids)"


def doc_words(t) -> DataFrame:
    docs = spread(t.documents.select("doc_id", "text", "source", "lang"), "doc_id")
    return docs.select("doc_id", "source", "lang", text.words("text").alias("tokens"))


def doc_ids(t) -> DataFrame:
    return doc_words(t).select("doc_id", "source", text.word_ids("tokens").alias("tokens"))


# candidate distributions: 16 candidates for each event
DISTS = """dists AS (SELECT event_id AS dist_id, tok::INTEGER AS token_id,
  ((event_id * 7919 + tok * 1299709) % 1000) / 100.0::DOUBLE - 5 AS logit FROM events, unnest(range(16)) AS r(tok))"""


def _logits(dist, salt: int):
    return F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: ((dist * 7919 + i.cast("long") * salt) % 1000) / F.lit(100.0) - 5,
    )


def dists(t) -> DataFrame:
    """Long form (dist_id, token_id, logit)."""
    rows = dealt(t.events.select("event_id"), "event_id")
    return rows.select(F.col("event_id").alias("dist_id"), F.posexplode(_logits(F.col("event_id"), 1299709)).alias("token_id", "logit"))


# scored positions: one event is one position, 50 users are the chunks
SCORED = """scored AS (SELECT user_id AS chunk, event_id AS pos, (floor(value * 100)::BIGINT % 16)::INTEGER AS target,
  list_transform(range(16), lambda i: ((event_id * 7919 + i * 1299709) % 1000) / 100.0::DOUBLE - 5) AS logits,
  list_transform(range(16), lambda i: ((event_id * 7919 + i * 1299721) % 1000) / 100.0::DOUBLE - 5) AS base_logits
  FROM events)"""


def scored(t) -> DataFrame:
    """Array form (chunk, pos, target, logits)."""
    rows = spread(t.events.select("event_id", "user_id", "value"), "event_id")
    return rows.select(
        F.col("user_id").alias("chunk"),
        F.col("event_id").alias("pos"),
        (F.floor(F.col("value") * 100) % 16).cast("int").alias("target"),
        _logits(F.col("event_id"), 1299709).alias("logits"),
        _logits(F.col("event_id"), 1299721).alias("base_logits"),
    )
