"""One query for each operator, with the SQL twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import chat_format, common, decontamination, html_extraction, line_dedup, manifest, packing, pii, quality_rules, secret_scans, sharding, simhash, token_counts, whitening
from loomspark.session import apply_runtime_conf


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scans.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *common.span_digest(F.col("spans"), secret_scans.KINDS, secret_scans.KINDS[:3]))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *common.span_digest(F.col("spans"), pii.KINDS, pii.BASE))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("host", "text_hash")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_length())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: A conversation whose texts are marks of the template themselves.
MARKED = "</s>[INST] ok [/INST]"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.formatted(rows.unionByName(marked)))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents")).drop("tampered", "segments")


OPERATORS = (
    op1_quality_rules, op2_secret_scans, op3_simhash, op4_sharding, op5_html_extraction,
    op6_line_dedup, op7_decontamination, op8_token_counts, op9_packing, op10_pii,
    op11_embedding_whitening, op12_chat_format, op13_merkle_manifest,
)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_decontamination": decontamination.ORACLE,
    "op9_packing": packing.ORACLE,
    "op12_chat_format": chat_format.oracle(f"SELECT -7, turn, role, '{MARKED}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)"),
    "op13_merkle_manifest": manifest.ORACLE,
}
