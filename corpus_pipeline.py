"""The corpus pipeline: from raw documents to padded batches, one operator a stage.

1. quality rules: documents that they reject go;
2. line dedup: boilerplate lines of a source go, documents stay;
3. SimHash near-dedup: one document of each component stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. packing: every document left gets its bucket, batch and place.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a lazy DataFrame; all but the last return
the columns of documents.  Nulls, repeated rows, empty tables and further columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import decontamination, line_dedup, packing, quality_rules, simhash
from loomspark.plans.scratch import written
from loomspark.session import apply_runtime_conf

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NO_ID = -(1 << 63)


def _without(docs: DataFrame, gone: DataFrame, what: str) -> DataFrame:
    """Rows of ``docs`` whose id, text and, where ``gone`` has it, host are not in ``gone``."""
    keys = {"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__hash": F.xxhash64("text"), "__host": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    listed = {"__id": F.coalesce("doc_id", F.lit(NO_ID)), "__hash": F.col("text_hash"), "__host": F.col("host") if "host" in gone.columns else None}
    used = [k for k, c in listed.items() if c is not None]
    table = written(gone.select(*[listed[k].alias(k) for k in used]).distinct(), what)
    return docs.withColumns({k: keys[k] for k in used}).join(table, used, "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(docs)
    return _without(docs, judged.filter(~F.col("kept")).select("doc_id", "host", "text_hash"), "rejected")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_lines(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs.select(*COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.select("doc_id", "text_hash"), "leaks")


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.word_length())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("packing", batches),
]

#: Links of fingerprints have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
