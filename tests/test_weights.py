"""Block codecs, names, shards and hashes."""

import hashlib
import uuid

import numpy as np
import pytest

from loomspark.functions import blocks as B
from loomspark.operators import weights as W


def wave(n, offset=0.0):
    return (0.1 + 2 * np.cos(np.arange(n) + offset)).astype(np.float32)


@pytest.mark.parametrize("kind,limit", [("F16", 0.001), ("BF16", 0.005), ("Q4_0", 0.15), ("Q4_1", 0.1), ("Q5_0", 0.08), ("Q5_1", 0.05), ("Q8_0", 0.01)])
def test_round_trip(kind, limit):
    x = wave(4096).reshape(4, 1024)
    raw = B.encode(x, kind)
    block, size = B.BLOCK_SIZES[kind]
    assert raw.shape == (4, 1024 // block * size)
    assert np.sqrt(np.mean((B.decode(raw, kind) - x) ** 2)) < limit


@pytest.mark.parametrize("kind", ["TQ1_0", "TQ2_0"])
def test_ternary_is_exact_on_ternary_rows(kind):
    x = np.random.default_rng(1).integers(-1, 2, size=(5, 512)).astype(np.float32) * 0.5
    assert np.array_equal(B.decode(B.encode(x, kind), kind), x)


def test_bytes_of_known_blocks():
    x = np.zeros((1, 32), dtype=np.float32)
    x[0, 0], x[0, 16], x[0, 31] = -8.0, 7.0, 4.0
    raw = B.encode(x, "Q4_0")[0]
    assert raw[:2].view("<f2")[0] == 1.0
    assert (raw[2] & 15, raw[2] >> 4, raw[17] >> 4, raw[3]) == (0, 15, 12, 0x88)
    q8 = B.encode(np.linspace(-127, 127, 32, dtype=np.float32)[None], "Q8_0")[0]
    assert q8[2:].view(np.int8)[0] == -127 and q8[2:].view(np.int8)[-1] == 127
    bf = B.encode(np.array([[1.0, np.nan]], dtype=np.float32), "BF16")[0].view("<u2")
    assert bf[0] == 0x3F80 and bf[1] & 0x7FC0 == 0x7FC0
    assert not B.encode(np.zeros((1, 32), dtype=np.float32), "Q5_1")[0].any()


def bits(raw, i, width):
    return (raw[i * width // 8] >> (i * width % 8)) & ((1 << width) - 1)


def scalar_decode(raw, kind):
    """One block, value by value, from the layout."""
    half = lambda at: float(np.frombuffer(raw[at : at + 2].tobytes(), "<f2")[0])
    out = np.zeros(256)
    for i in range(256):
        if kind == "Q2_K":
            s = int(raw[i // 16])
            q = (int(raw[16 + i // 128 * 32 + i % 32]) >> (i // 32 % 4 * 2)) & 3
            out[i] = half(80) * (s & 15) * q - half(82) * (s >> 4)
        elif kind == "Q6_K":
            g, r = divmod(i, 128)
            low = int(raw[g * 64 + r % 64]) >> (4 if r >= 64 else 0) & 15
            high = int(raw[128 + g * 32 + r % 32]) >> (r // 32 * 2) & 3
            scale = int(raw[192 + i // 16].astype(np.int8))
            out[i] = half(208) * scale * ((low | high << 4) - 32)
        elif kind in ("Q4_K", "Q5_K"):
            j, s = i // 32, [int(b) for b in raw[4:16]]
            sc, m = (s[j] & 63, s[j + 4] & 63) if j < 4 else (s[j + 4] & 15 | s[j - 4] >> 6 << 4, s[j + 4] >> 4 | s[j] >> 6 << 4)
            at = 16 if kind == "Q4_K" else 48
            q = int(raw[at + i // 64 * 32 + i % 32]) >> (4 if i // 32 % 2 else 0) & 15
            if kind == "Q5_K":
                q |= (int(raw[16 + i % 32]) >> j & 1) << 4
            out[i] = half(0) * sc * q - half(2) * m
        elif kind == "Q3_K":
            j, s = i // 16, [int(b) for b in raw[96:108]]
            low = s[j % 8] >> (4 if j >= 8 else 0) & 15
            scale = (low | (s[8 + j % 4] >> (j // 4 * 2) & 3) << 4) - 32
            q = int(raw[32 + i // 128 * 32 + i % 32]) >> (i // 32 % 4 * 2) & 3
            out[i] = half(108) * scale * (q - (0 if int(raw[i % 32]) >> (i // 32) & 1 else 4))
    return out


@pytest.mark.parametrize("kind", ["Q2_K", "Q3_K", "Q4_K", "Q5_K", "Q6_K"])
def test_large_blocks_against_single_values(kind):
    rng = np.random.default_rng(7)
    size = B.BLOCK_SIZES[kind][1]
    raw = rng.integers(0, 256, size=(3, size)).astype(np.uint8)
    for at in {"Q2_K": (80, 82), "Q3_K": (108,), "Q4_K": (0, 2), "Q5_K": (0, 2), "Q6_K": (208,)}[kind]:
        raw[:, at : at + 2] = np.array([0.01, 0.5, -0.25], dtype="<f2").view(np.uint8).reshape(3, 2)
    got = B.decode(raw, kind)
    want = np.stack([scalar_decode(r, kind) for r in raw])
    assert np.allclose(got, want, rtol=1e-5, atol=1e-6)


def test_indivisible_rows_fail():
    with pytest.raises(ValueError):
        B.encode(np.zeros((1, 33), dtype=np.float32), "Q4_0")


# Model ids and their parts: fixed values.
IDS = [
    ("Mistral/Mixtral-8x7B-Instruct-v0.1", 0, ("Mixtral-8x7B-Instruct-v0.1", "Mistral", "Mixtral", "Instruct", "v0.1", "8x7B")),
    ("Mixtral-8x7B", 0, ("Mixtral-8x7B", None, "Mixtral", None, None, "8x7B")),
    ("Mixtral-v0.1", 0, ("Mixtral-v0.1", None, "Mixtral", None, "v0.1", None)),
    ("Mixtral", 0, ("Mixtral", None, None, None, None, None)),
    ("NousResearch/Meta-Llama-3-8B", 0, ("Meta-Llama-3-8B", "NousResearch", "Meta-Llama-3", None, None, "8B")),
    ("Qwen1.5-MoE-A2.7B-Chat", 0, ("Qwen1.5-MoE-A2.7B-Chat", None, "Qwen1.5-MoE", "Chat", None, "A2.7B")),
    ("Qwen2-57B-A14B-Instruct", 0, ("Qwen2-57B-A14B-Instruct", None, "Qwen2", "Instruct", None, "57B-A14B")),
    ("microsoft/Phi-3-mini-4k-instruct", 4 * 10**9, ("Phi-3-mini-4k-instruct", "microsoft", "Phi-3", "4k-instruct", None, "mini")),
    ("delphi-suite/stories-llama2-50k", 50 * 10**3, ("stories-llama2-50k", "delphi-suite", "stories-llama2", None, None, "50K")),
    ("DeepSeek-Coder-V2-Lite-Instruct", 0, ("DeepSeek-Coder-V2-Lite-Instruct", None, "DeepSeek-Coder-V2-Lite", "Instruct", None, None)),
    ("crestf411/daybreak-kunoichi-2dpo-7b", 0, ("daybreak-kunoichi-2dpo-7b", "crestf411", "daybreak-kunoichi", "2dpo", None, "7B")),
    ("smallcloudai/Refact-1_6B-fim", 0, ("Refact-1_6B-fim", "smallcloudai", "Refact", "fim", None, "1.6B")),
    ("UCLA-AGI/Gemma-2-9B-It-SPPO-Iter3", 0, ("Gemma-2-9B-It-SPPO-Iter3", "UCLA-AGI", "Gemma-2", "It-SPPO", "Iter3", "9B")),
    ("internlm/internlm2_5-7b-chat-1m", 7 * 10**9, ("internlm2_5-7b-chat-1m", "internlm", "internlm2_5", "chat-1m", None, "7B")),
    ("abacaj/llama-161M-100B", 161 * 10**6, ("llama-161M-100B", "abacaj", "llama", "100b", None, "161M")),
    ("SparseLLM/relu-100B", 1340 * 10**6, ("relu-100B", "SparseLLM", "relu", "100b", None, None)),
    ("bigscience/bloom-7b1-petals", 0, ("bloom-7b1-petals", "bigscience", "bloom", "petals", None, "7.1B")),
    ("MaziyarPanahi/GreenNode-mini-7B-multilingual-v1olet-Mistral-7B-Instruct-v0.1", 0, ("GreenNode-mini-7B-multilingual-v1olet-Mistral-7B-Instruct-v0.1", "MaziyarPanahi", "GreenNode-mini", "multilingual-v1olet-Mistral-Instruct", "v0.1", "7B")),
    ("a plain sentence", 0, ("a plain sentence", None, None, None, None, None)),
]


def test_model_ids(spark):
    df = spark.createDataFrame([(i, m, p) for i, (m, p, _) in enumerate(IDS)], "i long, m string, p long")
    got = {r.i: tuple(r.x) for r in df.select("i", W.parse_model_id("m", df["p"]).alias("x")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(IDS)}


def test_hashes(spark):
    rows = [("f", i, n, bytearray(bytes([i]) * (i + 1))) for i, n in enumerate(["a", "b.attention.bias", "c"])]
    df = spark.createDataFrame(rows, "file string, idx long, tensor string, data binary")
    got = {(r.tensor, r.kind): r.hash for r in W.hash_tensors(df, ("sha1", "uuid")).collect()}
    space = uuid.UUID(W.UUID_SPACE)
    want_uuid = lambda raw: str(uuid.UUID(bytes=hashlib.sha1(space.bytes + raw).digest()[:16], version=5))
    assert got == {("a", "sha1"): hashlib.sha1(b"\0").hexdigest(), ("c", "sha1"): hashlib.sha1(b"\2\2\2").hexdigest(), ("a", "uuid"): want_uuid(b"\0"), ("c", "uuid"): want_uuid(b"\2\2\2")}
    whole = {r.kind: r.hash for r in W.hash_files(df, skip=()).collect()}
    assert whole["sha256"] == hashlib.sha256(b"\0\1\1\2\2\2").hexdigest()
    assert whole["uuid"] == want_uuid(b"\0\1\1\2\2\2")


def test_a_shard_set_must_be_whole(spark):
    rows = [("m-00001-of-00002.gguf", 0, "a", 2), ("m-00002-of-00002.gguf", 0, "b", None)]
    df = spark.createDataFrame(rows, "file string, idx long, tensor string, split_count long")
    assert [r.tensor for r in W.merge_shards(df).orderBy("pos").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        W.merge_shards(df.filter("idx = 0 AND tensor = 'b'"))


def test_adapter_merge(spark):
    rng = np.random.default_rng(2)
    w, a, b = rng.normal(size=(4, 6)), rng.normal(size=(2, 6)), rng.normal(size=(4, 2))
    base = spark.createDataFrame([("t", i, [float(x) for x in r]) for i, r in enumerate(w)], "tensor string, row long, values array<double>")
    ad = spark.createDataFrame([("t", a.tolist(), b.tolist(), 16.0, 0.5), ("t", a.tolist(), b.tolist(), 0.0, 2.0)], "tensor string, a array<array<double>>, b array<array<double>>, alpha double, strength double")
    got = np.array([r["values"] for r in W.merge_adapters(base, ad).orderBy("row").collect()])
    assert np.allclose(got, w + (0.5 * 16 / 2 + 2.0) * b @ a)


def test_unmapped_names_fail(spark):
    rules = spark.createDataFrame(W.DECODER_NAMES, "source string, target string")
    df = spark.createDataFrame([("model.layers.12.mlp.up_proj.weight",), ("odd",)], "tensor string")
    rows = W.map_tensor_names(df, rules, strict=False).collect()
    assert {r.tensor: r.mapped for r in rows} == {"model.layers.12.mlp.up_proj.weight": "blk.12.ffn_up.weight", "odd": None}
    with pytest.raises(Exception, match="no mapping"):
        W.map_tensor_names(df, rules).collect()


def test_xxh64_of_tensors_and_files(spark):
    import xxhash

    df = spark.createDataFrame([("f", 0, "a", b"one"), ("f", 1, "b", b""), ("g", 0, "a", b"two")], "file string, idx int, tensor string, data binary")
    got = {(r.file, r.tensor): r.hash for r in W.hash_tensors(df, ("xxh64",)).collect()}
    assert got == {(f, t): xxhash.xxh64(d).hexdigest() for f, t, d in (("f", "a", b"one"), ("f", "b", b""), ("g", "a", b"two"))}
    assert {r.file: r.hash for r in W.hash_files(df, ("xxh64",)).collect()} == {"f": xxhash.xxh64(b"one").hexdigest(), "g": xxhash.xxh64(b"two").hexdigest()}


def test_counts_that_no_long_holds_have_labels(spark, tmp_path):
    from loomspark.catalog.base import QUERIES

    keys = [(1, 1), (99, 10), (30_000, 9), (2_000_000, 300_000), (54_000_000, 5_400_000), (0, 7), (None, 3)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    rows = {r.k: r.label for r in QUERIES["g4_count_labels"](spark, str(tmp_path)).collect()}
    assert rows == {1: "2", 99: "~98K", 30_000: "~8B", 2_000_000: "~1200Q", 54_000_000: "~15746400Q", 0: "7", None: None}
