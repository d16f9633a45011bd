"""The driver contract, and registered queries beside DuckDB on the smallest tables."""

import pytest
from compare import compare, duck
from conftest import SF

import __spark_entry__ as entry

CHECKED = [
    "n2_static", "n4_predict", "n5_predict_validated", "w1_chunks", "w3_stride_windows", "w6_train_windows", "w7_pack_greedy", "w10_longest_common_run",
    "w11_match_prefix", "t1_normal_words", "t2_pretokenize_steps", "t3_bpe_round_trip", "t6_unigram_round_trip", "t17_category_ranges", "t18_speech_text",
    "e1_chunk_text", "e2_normalize", "e5_topk_neighbours", "e10_pool_mean_masked", "m3_pack_logprobs", "m6_kl_tokens", "m9_kld_report", "m12_wilson",
    "d7_typical", "d11_dry", "d18_chain", "p4_gemma", "p4_mistral_v3", "p6_parse_messages", "p11_infill", "p17_shuffle_shards", "c6_importance",
    "c8_diff_rows", "g5_adapter_totals", "g15_plan_mixed", "g16_quant_error", "g21_shards_by_size", "g25_merge_adapters", "b3_compare_builds",
    "b7_ancestors", "b11_success_matrix", "r1_split_reasoning", "r6_tagged_json", "r9_utf8_tails", "r13_conformance", "s4_quiz6", "s7_logit_files",
    "s8_tensor_data", "s13_transcripts", "x2_assembled_replies", "x3_service_buckets", "u5_embed_with",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 250


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ngram", "token", "cnt", "total"]
    assert df.limit(1).count() == 1


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""
