"""Sources with broken input, and streams in several batches against batch results."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.catalog.bench_queries import bench_rows
from loomspark.operators import calib as C
from loomspark.operators import ngrams as N
from loomspark.operators import vectors as V
from loomspark.sources import binary_files as bf
from loomspark.sources import tensor_files as tfile
from loomspark.sources import text_files as tf
from loomspark.streaming import jobs as J


def test_numbered_lines_cross_blocks(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = tf.numbered_lines(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.line == f"line {r.line_no}" for r in rows) and len(rows) == 5000


def test_numbered_lines_neither_sort_nor_move_a_block(spark, tmp_path, capsys):
    (tmp_path / "a").write_text("".join(f"a{i}\n" for i in range(300)))
    (tmp_path / "b").write_text("".join(f"b{i}\n" for i in range(200)))
    rows = tf.numbered_lines(spark, str(tmp_path))
    rows.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "row_number" not in plan
    assert sorted((r.line[0], r.line_no) for r in rows.collect()) == [(f, i) for f, n in (("a", 300), ("b", 200)) for i in range(n)] and all(r.line[1:] == str(r.line_no) for r in rows.collect())


def test_lines_of_a_quiz_are_dealt_before_they_are_sorted(spark, tmp_path, monkeypatch):
    (tmp_path / "q").write_text("".join(f"context {i}\n{i % 4}\na\nb\nc\nd\n" for i in range(1000)))
    monkeypatch.setattr(tf, "TASK_LINES", 100)
    rows = tf.read_quiz6(spark, str(tmp_path / "q"))
    assert rows.rdd.getNumPartitions() == 60
    assert sorted((r.task, r.context, r.gold, r.endings) for r in rows.collect()) == [(i, f"context {i}", i % 4, list("abcd")) for i in range(1000)]


def test_bench_files_are_compressed(spark, tables, tmp_path):
    rows = bench_rows(tables).limit(500)
    for fmt in ("jsonl", "csv"):
        tf.write_bench(rows, str(tmp_path / fmt), fmt)
        assert sum(f.stat().st_size for f in (tmp_path / fmt).glob("part-*")) < 50_000
        back = tf.read_bench(spark, str(tmp_path / fmt), fmt)
        assert back.count() == 500


def test_quiz_needs_six_lines(spark, tmp_path):
    (tmp_path / "q").write_text("a\n1\n2\n3\n")
    with pytest.raises(ValueError):
        tf.read_quiz6(spark, str(tmp_path / "q"))


def test_blank_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text('1,"A, _ b_",x,y,2\n2,no mark,x,y,1\n3,_,x,y,3\n4,a\n5,a _ b,x,"y, z",1')
    got = [tuple(r) for r in tf.read_blank_csv(spark, str(tmp_path / "b.csv")).orderBy("idx").collect()]
    assert got == [("1", "A, ", " b_", "x", "y", 2), ("5", "a ", " b", "x", '"y, z"', 1)]


def test_bench_rows_need_all_columns(spark, tables, tmp_path):
    rows = bench_rows(tables).limit(50)
    tf.write_bench(rows, str(tmp_path / "j"), "json")
    back = tf.read_bench(spark, str(tmp_path / "j"), "json")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    (tmp_path / "bad.json").write_text('{"build_commit": "x"}\n')
    with pytest.raises(Exception, match="lacks a column"):
        tf.read_bench(spark, str(tmp_path / "bad.json"), "jsonl").collect()


def test_pairs_must_match(spark, tmp_path):
    (tmp_path / "p").write_text("a\n\nb\n")
    (tmp_path / "n").write_text("c\n")
    with pytest.raises(Exception, match="different numbers"):
        tf.read_prompt_pairs(spark, str(tmp_path / "p"), str(tmp_path / "n")).collect()


def test_page_text(spark):
    html = "<html><head><title>T</title></head><body><h1>H</h1><p>one</p><p>two &amp; <b>three</b> " + "word " * 30 + "</p><script>x()</script></body></html>"
    text = tf.pages_to_text(spark.createDataFrame([(1, html)], "page_id long, html string")).first().text
    assert "two & three" in text and "x()" not in text and max(map(len, text.split("\n"))) <= 80


def logits_bytes(n_ctx=8, n_vocab=5, n_chunk=5):
    rng = np.random.default_rng(0)
    rows = b"".join(struct.pack("<2f", 0.5, -1) + rng.integers(0, 65536, 2 * ((n_vocab + 1) // 2)).astype("<u2").tobytes() for _ in range((n_ctx - 1 - n_ctx // 2) * n_chunk))
    return b"_logits_" + struct.pack("<Iii", n_ctx, n_vocab, n_chunk) + np.arange(n_ctx * n_chunk, dtype="<i4").tobytes() + rows


def test_logit_ranges_equal_whole_file(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(logits_bytes())
    whole = bf.parse_logits(spark.createDataFrame([(str(tmp_path / "x.bin"), bytearray(logits_bytes()))], "path string, content binary"))
    parts = bf.read_logits(spark, [str(tmp_path / "x.bin")], chunks_per_task=2)
    assert sorted(whole.collect()) == sorted(parts.collect())
    with pytest.raises(ValueError):
        bf.logits_layout(b"nonsense" + b"\0" * 12)


def test_broken_binaries_fail(spark):
    files = spark.createDataFrame([("f", bytearray(struct.pack("<4i", 1, -1, -1, -1) + struct.pack("<3i", 1, 7, 0)))], "path string, content binary")
    with pytest.raises(Exception, match="count of 0"):
        bf.parse_ngrams(files).collect()
    with pytest.raises(Exception, match="ends early"):
        bf.parse_importance(spark.createDataFrame([("f", bytearray(struct.pack("<2i", 1, 50)))], "path string, content binary")).collect()



def tensor_file(order="<", names=("a", "b"), keys=("k", "k")):
    head = struct.pack("<I", 0x46554747) + struct.pack(order + "IQQ", 3, len(names), len(keys))
    fix = (lambda s: struct.pack(order + "Q", len(s)) + s.encode())
    for i, k in enumerate(keys):
        head += fix(k) + struct.pack(order + "II", 4, i + 7)
    for i, n in enumerate(names):
        head += fix(n) + struct.pack(order + "IQIQ", 1, 4, 0, 32 * i)
    return head.ljust(-(-len(head) // 32) * 32, b"\0") + b"".join(np.full(4, i + 1, "<f4").tobytes().ljust(32, b"\0") for i in range(len(names)))


def test_tensor_files(spark, tmp_path):
    (tmp_path / "a.gguf").write_bytes(tensor_file())
    (tmp_path / "b.gguf").write_bytes(tensor_file(">"))
    kv = tfile.read_tensor_file(spark, str(tmp_path / "*.gguf"), "kv").collect()
    assert len(kv) == 4 and all(r["items"] == [str(r.idx + 7)] for r in kv)
    assert sum(r.key == "k" for r in kv) == 2 and all(r.key == "k" or r.key == f"k_{r.byte_offset}" for r in kv)
    data = tfile.read_tensor_file(spark, str(tmp_path / "a.gguf"), "data", tensorsPerTask=1, pieceBytes=8).orderBy("idx", "part").collect()
    assert len(data) == 4 and np.frombuffer(b"".join(bytes(r.data) for r in data), "<f4").tolist() == [1.0] * 4 + [2.0] * 4


@pytest.mark.parametrize(
    "raw,message",
    [(tensor_file(names=("a", "a")), "two tensors"), (b"GGUX" + tensor_file()[4:], "not a tensor file"), (tensor_file()[:40], "ends early"), (tensor_file()[:4] + struct.pack("<I", 9) + tensor_file()[8:], "version 9")],
)
def test_broken_tensor_files_fail(spark, tmp_path, raw, message):
    (tmp_path / "x.gguf").write_bytes(raw)
    with pytest.raises(Exception, match=message):
        tfile.read_tensor_file(spark, str(tmp_path / "x.gguf")).collect()


def test_streamed_ngrams_over_several_batches(spark, tmp_path):
    docs = [(d, [f"w{(d * 7 + i * i) % 5}" for i in range(40)]) for d in range(6)]
    for batch in range(4):
        rows = [(d, batch, toks[batch * 10 : batch * 10 + 10]) for d, toks in docs]
        spark.createDataFrame(rows, "doc_id long, seq long, tokens array<string>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "doc_id long, seq long, tokens array<string>", files_per_batch=1)
    out = J.run_to_table(J.incremental_ngrams(stream), "ngrams")
    streamed = out.filter("n > 0").groupBy("n", "ngram", "token").agg(F.sum("cnt").alias("cnt")).collect()
    batch_counts = N.ngram_counts(spark.createDataFrame(docs, "doc_id long, tokens array<string>")).collect()
    key = lambda r: (r.n, tuple(r.ngram), r.token, r.cnt)
    assert out.agg(F.sum("gap")).first()[0] == 0
    assert sorted(map(key, streamed)) == sorted(map(key, batch_counts))


def test_replies_hold_back_partial_stops(spark, tmp_path):
    parts = [["ab<", "b>c", "</", "s>", "never"], ["x", "</", "z"], ["y</s"]]
    for seq in range(5):
        rows = [(i, seq, p[seq], seq == len(p) - 1) for i, p in enumerate(parts) if seq < len(p)]
        spark.createDataFrame(rows, "reply_id long, seq long, delta string, last boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "reply_id long, seq long, delta string, last boolean")
    out = J.run_to_table(J.assemble_replies(stream, ["</s>"]), "replies").orderBy("reply_id", "seq").collect()
    texts = {i: "".join(r.text for r in out if r.reply_id == i) for i in range(3)}
    assert texts == {0: "ab<b>c", 1: "x</z", 2: "y</s"}
    assert [r.text for r in out if r.reply_id == 0][0] == "ab"


def test_ngrams_do_not_reach_over_a_gap(spark, tmp_path):
    for seq, toks in ((0, ["a", "b"]), (2, ["c", "d"]), (1, ["x", "y"]), (3, ["e"])):
        spark.createDataFrame([(1, seq, toks)], "doc_id long, seq long, tokens array<string>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "doc_id long, seq long, tokens array<string>")
    out = J.run_to_table(J.incremental_ngrams(stream, 1, 2), "gaps").collect()
    grams = {(*r.ngram, r.token) for r in out if r.n}
    assert sum(r.gap for r in out) >= 2 and ("a", "b") in grams and ("c", "d") in grams and ("d", "e") in grams
    assert not grams & {("b", "c"), ("b", "x"), ("d", "x"), ("y", "e")}


def test_deltas_wait_for_their_turn_over_batches(spark, tmp_path):
    deltas = [(1, 2, "c", False), (1, 0, "a", False), (1, 0, "again", False), (1, 3, "d", True), (1, 1, "b", False), (1, 4, "late", False)]
    for d in deltas:
        spark.createDataFrame([d], "reply_id long, seq long, delta string, last boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "reply_id long, seq long, delta string, last boolean")
    out = J.run_to_table(J.assemble_replies(stream, ["</s>"]), "waiting").orderBy("seq").collect()
    assert [(r.seq, r.text, r.done) for r in out] == [(0, "a", False), (1, "b", False), (2, "c", False), (3, "d", True)]


def test_running_sums_snapshot_every_second_batch(spark, tmp_path):
    for b in range(4):
        spark.createDataFrame([("t", 0, c, float(b + c)) for c in range(3)], "tensor string, expert int, col int, x double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "tensor string, expert int, col int, x double")
    snaps = J.run_snapshots(J.running_importance(stream), "imp", every=2)
    assert sorted(r.batch for r in snaps.select("batch").distinct().collect()) == [0, 2]
    assert {r.col: r.cnt for r in J.latest(snaps).collect()} == {0: 3, 1: 3, 2: 3}


def test_chunks_count_bytes(spark):
    text = "é\nab\nçç\nx"
    rows = V.chunk_text(spark.createDataFrame([("f", text)], "filename string, text string"), 3, "\n").orderBy("chunk_no").collect()
    assert [(r.byte_offset, r.chunk) for r in rows] == [(0, "é\nab\n"), (6, "çç\nx")]
    alone = V.chunk_text(spark.createDataFrame([("f", "abc")], "filename string, text string"), 100, "\n").collect()
    assert [(r.byte_offset, r.chunk) for r in alone] == [(0, "abc")]


def test_topk_blocks_equal_broadcast(spark, tables):
    rows = tables.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    q, c = rows.withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "doc_id")
    key = lambda r: (r.query_id, r["rank"], r.doc_id)
    assert sorted(map(key, V.topk_similar(q, c, 4).collect())) == sorted(map(key, V.topk_similar(q, c, 4, max_queries=16).collect()))


def test_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r.c for r in df.select(V.cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [1.0, 0.0, 1.0]


def test_principal_direction(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 8)) * np.array([5, 1, 1, 1, 1, 1, 1, 1.0])
    df = spark.createDataFrame([(0, r.tolist()) for r in x], "layer int, vec array<double>").repartition(5)
    got = np.array(C.direction_pca(df).first().vec)
    vals, vecs = np.linalg.eigh(x.T @ x)
    assert abs(abs(got @ vecs[:, -1]) - 1) < 1e-6 and got[np.abs(got).argmax()] > 0


def test_odd_directions_fail(spark):
    with pytest.raises(Exception, match="must be named"):
        C.combine_directions(spark.createDataFrame([("f", "direction.0", [1.0], 1.0)], "file string, name string, vec array<double>, strength double")).collect()
    with pytest.raises(ValueError):
        C.assert_dims(spark.createDataFrame([("a", 1), ("a", 2)], "tensor string, dim int"))


def test_a_task_with_too_many_answers_is_bad_and_whole(spark):
    import struct

    text = lambda s: struct.pack("<I", len(s)) + s.encode()
    few = struct.pack("<I", 2) + text("yes") + text("no") + struct.pack("<2i", 1, 0)
    many = struct.pack("<I", 101) + text("x") * 101 + struct.pack("<101i", *[0] * 101)
    raw = struct.pack("<III", 2, 0, 0) + text("good") + few + few + text("bad") + few + many
    files = spark.createDataFrame([("f", bytearray(raw))], "path string, content binary")
    rows = [(r.question, r.mode, r.answer_no, r.answer, r.label, r.bad) for r in bf.parse_choices(files).collect()]
    assert rows[:2] == [("good", "single", 0, "yes", 1, False), ("good", "single", 1, "no", 0, False)]
    assert rows[6:] == [("bad", "multi", k, "x", 0, True) for k in range(101)]


def test_a_stream_opens_as_many_stores_as_there_are_cores(spark, tmp_path):
    spark.createDataFrame([(1, 0, "a", True)], "reply_id long, seq long, delta string, last boolean").write.parquet(str(tmp_path / "in"))
    usual, progress = spark.conf.get("spark.sql.shuffle.partitions"), []
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        stream = J.folder_stream(spark, str(tmp_path / "in"), "reply_id long, seq long, delta string, last boolean")
        out = J.run_to_table(J.assemble_replies(stream, ["</s>"]), "stores", progress=progress).collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64" and [r.text for r in out] == ["a"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert progress[0]["stateOperators"][0]["numShufflePartitions"] == spark.sparkContext.defaultParallelism


def test_deltas_without_a_reply_take_no_reply_with_them(spark, tmp_path):
    rows = [(i if i % 4 else None, 0, f"t{i}", True) for i in range(40)]
    spark.createDataFrame(rows, "reply_id long, seq long, delta string, last boolean").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = J.folder_stream(spark, str(tmp_path / "in"), "reply_id long, seq long, delta string, last boolean")
    out = J.run_to_table(J.assemble_replies(stream, ["</s>"]), "nulls").collect()
    assert {r.reply_id: r.text for r in out if r.reply_id is not None} == {i: f"t{i}" for i in range(40) if i % 4}
