"""What has to hold when inputs grow: ranges of files, state that goes, contracted chains, dense sums, blocks, linear cuts."""

import random
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.operators import benchmarks as B
from loomspark.operators import calib as C
from loomspark.operators import ngrams as N
from loomspark.operators import prep as P
from loomspark.operators import tokens as T
from loomspark.operators import vectors as V
from loomspark.operators import weights as Wt
from loomspark.operators import windows as W
from loomspark.sources import binary_files as bf
from loomspark.sources import ranges as R
from loomspark.sources import tensor_files as tfile
from loomspark.streaming import jobs as J

# files in ranges


def text(s):
    return struct.pack("<I", len(s.encode())) + s.encode()


def tasks_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    n_ctx, n_vocab, n_chunk = 8, 5, 40
    rng = np.random.default_rng(1)
    body = b"".join(struct.pack("<2f", 0.5, -1) + rng.integers(0, 65536, 6).astype("<u2").tobytes() for _ in range(3 * n_chunk))
    raw = b"_logits_" + struct.pack("<Iii", n_ctx, n_vocab, n_chunk) + np.arange(n_ctx * n_chunk, dtype="<i4").tobytes() + body
    R.write_files(spark.createDataFrame([("a b%.bin", bytearray(raw))], "path string, content binary"), f"file://{tmp_path}/logits")
    rows = bf.read_logits(spark, f"{tmp_path}/logits", chunks_per_task=3)
    assert tasks_of(rows) > 1
    whole = bf.parse_logits(spark.createDataFrame([("x", bytearray(raw))], "path string, content binary"))
    assert sorted(map(tuple, rows.drop("path").collect())) == sorted(map(tuple, whole.drop("path").collect()))


@pytest.mark.parametrize("kind", ["choices", "importance", "ngrams"])
def test_ranges_equal_whole_files(spark, tmp_path, kind):
    rng = random.Random(2)
    if kind == "choices":
        answers = lambda k: struct.pack("<I", k) + b"".join(text(f"é{i}" * rng.randint(0, 5)) for i in range(k)) + struct.pack(f"<{k}i", *range(k))
        raw = struct.pack("<I", 50) + b"\0" * 200 + b"".join(text(f"question {i}") + answers(rng.randint(0, 6)) + answers(2) for i in range(50))
        parse, read = bf.parse_choices, bf.read_choice_bin
    elif kind == "importance":
        raw = struct.pack("<i", 30) + b"".join(struct.pack("<i", 5) + f"t{i:04d}".encode() + struct.pack("<ii", i + 1, n) + np.arange(n, dtype="<f4").tobytes() for i in range(30) for n in [rng.randint(1, 60)]) + b"tail"
        parse, read = bf.parse_importance, bf.read_importance
    else:
        raw = b"".join(struct.pack("<4i", i, -1, -1, -1) + struct.pack("<i", k) + struct.pack(f"<{2 * k}i", *[x + 1 for x in range(2 * k)]) for i in range(60) for k in [rng.randint(1, 9)])
        parse, read = bf.parse_ngrams, bf.read_ngrams
    (tmp_path / "f").write_bytes(raw)
    rows = read(spark, str(tmp_path / "f"), range_bytes=300)
    assert tasks_of(rows) > 1
    drop = lambda df: sorted(str(tuple(r)) for r in df.drop("path").collect())
    assert drop(rows) == drop(parse(spark.createDataFrame([("f", bytearray(raw))], "path string, content binary"))) != []


def test_rows_of_small_files_share_frames():
    lists = [[(f"f{i}", i, 0, 1)] for i in range(120)]
    got = list(R.frames(iter(lists), R.RANGES))
    assert len(got) == 1 and list(got[0].columns) == ["path", "start", "first", "n"] and len(got[0]) == 120
    assert [len(f) for f in R.frames(([("p", 0, 0, 1)] * 30_000 for _ in range(5)), R.RANGES)] == [60_000, 60_000, 30_000]


def test_tasks_list_folders(spark, tmp_path):
    top = tmp_path / "in"
    for name in ("in/part=1/x", "in/part=1/_y", "in/part=2/x", "flat/a", "flat/b c%.bin", "flat/d=1", "flat/_hidden", "flat/.hidden", "flat/deeper/y"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    for path in (str(top), f"file://{top}", [f"{tmp_path}/flat/a", f"file:{top}/part=1/"], f"{tmp_path}/flat"):
        got = R.list_files(spark, path)
        assert not got.inputFiles()  # nothing is listed on the driver
        spark_lists = spark.read.format("binaryFile").load(path).select("path", "length").collect()
        plain = path[0] == "/"
        assert sorted((r.path.removeprefix("file:") if plain else r.path, r.length) for r in spark_lists) == sorted(map(tuple, got.collect())) != []
    assert R.list_files(spark, f"{top}/part=1/x").first().path == f"{top}/part=1/x" and R.list_files(spark, f"{top}/part=*/x").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.list_files(spark, f"{top}/nothing").collect()


def test_written_files_are_dealt_to_parts(spark, tmp_path):
    files = spark.range(300).select(F.col("id").cast("string").alias("path"), F.col("id").cast("string").cast("binary").alias("content"))
    folder = R.write_files(files, f"{tmp_path}/out")
    assert max(len(list(d.iterdir())) for d in (tmp_path / "out").iterdir()) < 20
    assert sorted(int(r.path.rsplit("/", 1)[1]) for r in R.list_files(spark, folder).collect()) == list(range(300))


def test_a_document_is_counted_and_written_where_it_was_dealt(spark, monkeypatch, capsys):
    from loomspark.catalog import source_queries as S
    from loomspark.catalog.base import QUERIES

    seen = []
    monkeypatch.setattr(S, "write_files", lambda files, folder: (seen.append(files), R.write_files(files, folder))[1])
    rows = QUERIES["s10_ngram_files"](spark, "/root/testdata/sf0.001")
    seen[0].explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning(doc_id" in plan and "token" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert rows.filter("cnt > 0").count() > 0


def test_a_tensor_comes_in_pieces_of_several_tasks(spark, tmp_path):
    head = struct.pack("<IIQQ", 0x46554747, 3, 2, 0)
    for name, n, at in (("a", 1000, 0), ("b", 0, 4000)):
        head += struct.pack("<Q", 1) + name.encode() + struct.pack("<IQIQ", 1, n, 0, at)
    raw = head.ljust(-(-len(head) // 32) * 32, b"\0") + np.arange(1000, dtype="<f4").tobytes()
    (tmp_path / "x.tensors").write_bytes(raw)
    rows = tfile.read_tensor_file(spark, str(tmp_path / "*.tensors"), "data", rangeBytes=512, pieceBytes=256)
    assert tasks_of(rows) > 4
    got = sorted((r.tensor, r.part, bytes(r.data)) for r in rows.collect())
    assert np.frombuffer(b"".join(d for t, _, d in got if t == "a"), "<f4").tolist() == list(map(float, range(1000))) and [g for g in got if g[0] == "b"] == [("b", 0, b"")]
    (tmp_path / "y.tensors").write_bytes(raw[:-4])
    with pytest.raises(Exception, match="ends inside a"):
        tfile.read_tensor_file(spark, str(tmp_path / "y.tensors"), "data").collect()


@pytest.mark.parametrize("what", ["kv", "tensors", "data"])
def test_small_tensor_files_share_tasks(spark, tmp_path, what):
    for i in range(50):
        head = struct.pack("<IIQQQ", 0x46554747, 3, 1, 1, 1) + b"k" + struct.pack("<II", 4, i)
        head += struct.pack("<Q", 1) + b"a" + struct.pack("<IQIQ", 1, 2, 0, 0)
        (tmp_path / f"{i}.tensors").write_bytes(head.ljust(-(-len(head) // 32) * 32, b"\0") + np.array([i, i], "<f4").tobytes())
    rows = tfile.read_tensor_file(spark, str(tmp_path / "*.tensors"), what)
    assert rows.rdd.getNumPartitions() == 1 and rows.select("file").distinct().count() == rows.count() == 50
    apart = tfile.read_tensor_file(spark, str(tmp_path / "*.tensors"), what, rangeBytes=10 << 20)
    assert 5 <= apart.rdd.getNumPartitions() <= 6 and sorted(map(str, apart.collect())) == sorted(map(str, rows.collect()))


def test_pieces_of_tensors_hash_like_whole_ones(spark):
    import hashlib

    raw = {("f", "a"): bytes(range(256)) * 40, ("f", "b"): b"x", ("g", "a"): b""}
    pieces = [(f, i, t, p, bytearray(data[k : k + 100])) for i, ((f, t), data) in enumerate(raw.items()) for p, k in enumerate(range(0, max(len(data), 1), 100))]
    random.Random(1).shuffle(pieces)
    df = spark.createDataFrame(pieces, "file string, idx long, tensor string, part long, data binary").repartition(4)
    got = {(r.file, r.tensor, r.kind): r.hash for r in Wt.hash_tensors(df, ("sha256", "sha1")).collect()}
    assert got == {(*k, kind): hashlib.new(kind, data).hexdigest() for k, data in raw.items() for kind in ("sha256", "sha1")}
    whole = {(r.file, r.kind): r.hash for r in Wt.hash_files(df, ("sha256",)).collect()}
    assert whole == {("f", "sha256"): hashlib.sha256(raw["f", "a"] + raw["f", "b"]).hexdigest(), ("g", "sha256"): hashlib.sha256(b"").hexdigest()}


# streams


def write_batch(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.02)  # files are read in the order of their times


def at(minute):
    return f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"


def state_rows(progress):
    return [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]


def test_replies_over_batches_a_restart_and_idle_time(spark, tmp_path):
    schema = "reply_id long, seq long, delta string, last boolean, ts string"
    n = 20
    batches = [[(i, s, f"{i}.{s} ", False, at(s)) for i in range(n) if not (i == 3 and s == 1)] for s in range(3)]
    batches.append([(3, 1, "3.1 ", False, at(3))])  # a late delta
    batches += [[(i, 3, "end</s>never", False, at(4)) for i in range(n) if i != 5], [(7, 4, "after the end", True, at(5))]]
    batches += [[(100, 0, "later ", False, at(200))], [(100, 1, "x", True, at(400))], [(2, 4, "much too late", True, at(6))]]
    table, path, progress = None, f"{tmp_path}/job", []
    for k, rows in enumerate(batches):
        write_batch(spark, rows, schema, tmp_path / "in")
        if k in (2, 5, len(batches) - 1):  # three runs of one job
            stream = J.folder_stream(spark, str(tmp_path / "in"), schema)
            table = J.run_to_table(J.assemble_replies(stream, ["</s>"], ts="ts", idle_ms=3_600_000), "replies", path, progress)
    got = {}
    for r in table.orderBy("seq").collect():
        got.setdefault(r.reply_id, []).append((r.text, r.done))
    for i in range(n):
        assert "".join(t for t, _ in got[i]) == f"{i}.0 {i}.1 {i}.2 " + ("end" if i != 5 else ""), got[i]
        assert [d for _, d in got[i]].count(True) == 1  # the open one is closed when it has been idle
    rows = state_rows(progress)
    assert len(rows) >= 8 and max(rows) >= 2 * n and rows[-1] < 8


def test_ngram_state_goes_when_documents_are_idle(spark, tmp_path):
    schema = "doc_id long, seq long, tokens array<string>, ts string"
    docs = {d: [f"w{(d * 5 + i * i) % 4}" for i in range(30)] for d in range(8)}
    progress = []
    for k in range(5):
        write_batch(spark, [(d, k, toks[6 * k : 6 * k + 6], at(k)) for d, toks in docs.items()], schema, tmp_path / "in")
    for k in (300, 600):
        write_batch(spark, [(99, 0, [], at(k))], schema, tmp_path / "in")
    out = J.run_to_table(J.incremental_ngrams(J.folder_stream(spark, str(tmp_path / "in"), schema), ts="ts"), "ngrams", progress=progress)
    streamed = {(r.n, tuple(r.ngram), r.token): r.cnt for r in out.filter("n > 0").groupBy("n", "ngram", "token").agg(F.sum("cnt").alias("cnt")).collect()}
    batch = N.ngram_counts(spark.createDataFrame(list(docs.items()), "doc_id long, tokens array<string>"))
    assert streamed == {(r.n, tuple(r.ngram), r.token): r.cnt for r in batch.collect()}
    rows = state_rows(progress)
    assert len(rows) >= 7 and max(rows) >= 3 * len(docs) and rows[-1] < 10


def test_replies_of_a_group_share_calls_and_a_timer(spark, tmp_path):
    schema, progress = "reply_id long, seq long, delta string, last boolean, ts string", []
    n = 2 * J.GROUPS
    write_batch(spark, [(i, s, f"{i}.{s} ", False, at(1)) for i in range(n) for s in (0, 2)], schema, tmp_path / "in")
    write_batch(spark, [(i, 1, f"{i}.1 ", i % 2 == 0, at(2)) for i in range(n)], schema, tmp_path / "in")
    for minute in (300, 600):
        write_batch(spark, [(-1, 0, "", True, at(minute))], schema, tmp_path / "in")
    stream = J.folder_stream(spark, str(tmp_path / "in"), schema)
    rows = J.run_to_table(J.assemble_replies(stream, ["</s>"], ts="ts"), "replies", progress=progress).filter("reply_id >= 0").orderBy("seq").collect()
    got = {}
    for r in rows:
        got.setdefault(r.reply_id, []).append((r.text, r.done))
    assert {i: "".join(t for t, _ in v) for i, v in got.items()} == {i: f"{i}.0 {i}.1 " + (f"{i}.2 " if i % 2 else "") for i in range(n)}
    assert all([d for _, d in v].count(True) == 1 for v in got.values())
    assert max(p["stateOperators"][0]["customMetrics"].get("numRegisteredTimers", 0) for p in progress) <= J.GROUPS
    assert max(state_rows(progress)) >= n and state_rows(progress)[-1] <= 6


def test_deltas_ahead_wait_in_rows_of_their_batch(spark, tmp_path):
    schema, progress = "reply_id long, seq long, delta string, last boolean", []
    for seqs in ([2, 3, 4, 5, 9], [5, 7, 8], [0], [1], [6, 2], [10]):
        write_batch(spark, [(1, s, f"{s} " if s != 3 else None, s == 10) for s in seqs], schema, tmp_path / "in")
    out = J.run_to_table(J.assemble_replies(J.folder_stream(spark, str(tmp_path / "in"), schema), ["</s>"]), "replies", progress=progress)
    assert "".join(r.text for r in out.orderBy("seq").collect()) == "0 1 2 4 5 6 7 8 9 10 "
    assert state_rows(progress)[:6] == [3, 4, 4, 4, 2, 2]  # a timer, the reply, and one row for each batch


def test_replies_of_one_group_go_each_in_its_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "GROUPS", 1)
    schema, progress = "reply_id long, seq long, delta string, last boolean, ts string", []
    n = 30
    write_batch(spark, [(i, 0, f"{i} <", False, at(i)) for i in range(n)] + [(i, 2, "never", False, at(i)) for i in range(n)], schema, tmp_path / "in")
    write_batch(spark, [(3, 1, "kept", False, at(50))], schema, tmp_path / "in")  # few of many: read by themselves
    for minute in (80, 81, 82, 400, 401):  # a row's watermark holds from the next batch on
        write_batch(spark, [(100 + minute, 0, "x", True, at(minute))], schema, tmp_path / "in")
    table = J.run_to_table(J.assemble_replies(J.folder_stream(spark, str(tmp_path / "in"), schema), ["<s>"], ts="ts"), "replies", progress=progress)
    got = {}
    for r in table.filter("reply_id < 100").orderBy("seq").collect():
        got.setdefault(r.reply_id, []).append((r.text, r.done))
    assert got == {i: [(f"{i} ", False), ("<", True)] if i != 3 else [("3 ", False), ("<kept", False), ("never", False), ("", True)] for i in range(n)}
    held = state_rows(progress)
    # Idle for an hour and ten minutes late: at 80 those before minute 10 go, 3 being heard of at 50.
    assert max(held) == 2 * n + 1 and any(30 < rows < 50 for rows in held) and held[-1] <= 3


def test_chunks_of_a_group_share_calls_and_a_timer(spark, tmp_path):
    schema, progress = "doc_id long, seq long, tokens array<string>, ts string", []
    odd = ["a", "\x01", "", "b\x02n", None, "\x02", "a", "\x01"]
    docs = {d: [odd[(d + i * i) % 8] for i in range(9)] for d in range(2 * J.GROUPS)}
    docs[None] = ["x", "", "x"]
    for k in range(3):
        write_batch(spark, [(d, k, toks[3 * k : 3 * k + 3], at(k)) for d, toks in docs.items()], schema, tmp_path / "in")
    out = J.run_to_table(J.incremental_ngrams(J.folder_stream(spark, str(tmp_path / "in"), schema), ts="ts"), "ngrams", progress=progress)
    want = {}
    for toks in docs.values():
        for i, n in ((i, n) for i in range(len(toks)) for n in range(1, min(4, i) + 1)):
            key = (n, tuple(toks[i - n : i]), toks[i])
            want[key] = want.get(key, 0) + 1
    assert {(r.n, tuple(r.ngram), r.token): r.cnt for r in out.groupBy("n", "ngram", "token").agg(F.sum("cnt").alias("cnt")).collect()} == want
    assert max(p["stateOperators"][0]["customMetrics"].get("numRegisteredTimers", 0) for p in progress) <= J.GROUPS


def test_a_message_is_split_once(spark):
    from loomspark.catalog.base import Tables
    from loomspark.catalog.stream_queries import word_deltas

    rows = word_deltas(Tables(spark, "/root/testdata/sf0.001"))
    above, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
    assert "split(text" in below and "split(text" not in above


# drafts


def test_rounds_read_the_tables_where_they_lie(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice("abcd") for _ in range(30)]) for i in range(50)]
    docs = spark.createDataFrame(rows, "prompt_id long, tokens array<string>")
    tables = N.draft_tables(N.ngram_flat(docs, keep=("prompt_id",)), N.ngram_flat(docs), N.ngram_flat(docs, 2, 2))
    state = docs.select("prompt_id", F.slice("tokens", -4, 4).alias("tail"), F.lit(True).alias("open"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = N.draft_round(state, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("\n")
    scans = [k for k, line in enumerate(lines) if "FileScan" in line]
    assert len(scans) >= 8 and all("Bucketed: true" in lines[k] for k in scans)
    for k in scans:  # no exchange between a table and its join
        above = []
        depth = len(lines[k]) - len(lines[k].lstrip(" :+-"))
        for line in reversed(lines[:k]):
            d = len(line) - len(line.lstrip(" :+-"))
            if d < depth:
                depth = d
                above.append(line)
                if "Join" in line:
                    break
        assert not any("Exchange" in line for line in above)


def test_sizes_are_summed_from_wider_ones(spark):
    rng = random.Random(8)
    docs = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 9))]) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    want = {}
    for _, seq in docs:
        for n in range(2, 5):
            for i in range(n, len(seq)):
                key = (n, tuple(seq[i - n : i]), seq[i])
                want[key] = want.get(key, 0) + 1
    assert {(r.n, tuple(r.ngram), r.token): r.cnt for r in N.ngram_counts(df, 2, 4).collect()} == want


def plain_counts(docs, n_min, n_max):
    want = {}
    for seq in docs:
        for n in range(n_min, n_max + 1):
            for i in range(n, len(seq)):
                key = (n, tuple(seq[i - n : i]), seq[i])
                want[key] = want.get(key, 0) + 1
    return want


def flat_counts(df):
    return {(r.n, tuple(r[f"p{k}"] for k in range(r.n, 0, -1)), r.token): r.cnt for r in df.collect()}


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange " in line]


@pytest.mark.parametrize("words", [["a", "the", "word", "longer", "longest", ""], ["\x01", "\x02", "\x02a", "\x02n", "\x02\x01b", "n"], [1, 22, 123456, 1234567]])
def test_runs_hold_every_ngram(spark, words):
    rng = random.Random(5)
    docs = [[rng.choice(words) for _ in range(rng.randint(0, 9))] for _ in range(60)]
    kind = "long" if isinstance(words[0], int) else "string"
    df = spark.createDataFrame([(i, seq) for i, seq in enumerate([*docs, None])], f"doc_id long, tokens array<{kind}>")
    for sizes in ((2, 2), (1, 4), (3, 4), (1, 2)):
        flat = N.ngram_flat(df, *sizes, parts=3)
        assert flat_counts(flat) == plain_counts(docs, *sizes)
        assert flat.filter("n > 1").groupBy("p2", "p1").agg(F.countDistinct("anchor").alias("k")).filter("k <> 1").isEmpty()


def test_missing_tokens_in_runs_are_those_of_rows(spark):
    df = spark.createDataFrame([(1, ["a", None, "b", "longer", None, None, "a"]), (2, [None]), (3, [None, "b"])], "doc_id long, tokens array<string>")
    key = lambda d: sorted(map(repr, d.select("n", "p4", "p3", "p2", "p1", "token", "cnt").collect()))
    assert key(N.ngram_flat(df, parts=2)) == key(N.ngram_flat(df.withColumn("all", F.lit(1)), keep=("all",)))


def test_text_is_shuffled_once_for_predictions(spark):
    rng = random.Random(6)
    docs = [[rng.choice(["a", "the", "longer", "longest"]) for _ in range(12)] for _ in range(40)]
    df = spark.createDataFrame([(seq,) for seq in docs], "tokens array<string>")
    static = N.ngram_flat(df, 2, 2, parts=3)
    assert len(exchanges(N.ngram_predict(static))) == 1
    counts = plain_counts(docs, 2, 2)
    best = {g: min((-c, t) for (_, h, t), c in counts.items() if h == g) for _, g, _ in counts}
    totals = {g: sum(c for (_, h, _), c in counts.items() if h == g) for g in best}
    want = {(g, t, -c, totals[g]) for g, (c, t) in best.items() if totals[g] >= 2 and -100 * c >= 50 * totals[g]}
    assert {(tuple(r.ngram), r.token, r.cnt, r.total) for r in N.ngram_predict(static).collect()} == want


def test_static_counts_meet_grams_where_both_lie(spark):
    rng = random.Random(7)
    words = ["a", "the", "longer", "longest"]
    chats, docs = ([[rng.choice(words) for _ in range(9)] for _ in range(n)] for n in (30, 40))
    left, right = (spark.createDataFrame([(seq,) for seq in rows], "tokens array<string>") for rows in (chats, docs))
    out = N.ngram_predict_validated(N.ngram_flat(left, 2, 4, parts=3), N.ngram_flat(right, 2, 2, parts=3))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert len({line.split("Exchange")[1].split("hashpartitioning")[0] for line in exchanges(out)}) == 1 and len(exchanges(out)) == 4  # three reuse one
    counts, static = plain_counts(chats, 2, 4), plain_counts(docs, 2, 2)
    want = set()
    for n, g in {key[:2] for key in counts}:
        part = {t: c for (m, h, t), c in counts.items() if (m, h) == (n, g)}
        top = min(part, key=lambda t: (-part[t] * (100 * static[2, g[-2:], t] if (2, g[-2:], t) in static else 1), t))
        total = sum(part.values())
        if total >= N.LAX_SAMPLES[n - 1] and 100 * part[top] >= N.LAX_PERCENT[n - 1] * total:
            want.add((n, g, top, part[top], total))
    assert {(r.n, tuple(r.ngram), r.token, r.cnt, r.total) for r in out.collect()} == want


def test_static_counts_of_drafts_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    docs = spark.createDataFrame([(i, list("abcabd")) for i in range(5)], "prompt_id long, tokens array<string>")
    counts = N.ngram_static(docs)
    static = counts.mapInPandas(told, counts.schema)
    _, resident, _ = N.draft_tables(N.ngram_counts(docs, keep=("prompt_id",)), N.ngram_counts(docs), static)
    assert seen.value == counts.count() == resident.count()


# vectors


def test_pooling_sums_what_is_there(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, None]), ("a", None), ("b", []), (None, [5.0]), ("a", [5.0, 6.0, 7.0]), (None, [7.0])]
    df = spark.createDataFrame(rows, "seq string, vec array<double>").repartition(3)
    assert {r.seq: r.vec for r in V.pool_mean(df).collect()} == {"a": [3.0, 4.0, 7.0], None: [6.0]}


def test_hot_sequence_hands_on_a_row_for_each_task(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("seq"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
    assert V.pool_mean(df).first().vec == [9999.5, 1.0]
    many = spark.range(3000, numPartitions=2).select(F.col("id").alias("seq"), F.array(F.col("id").cast("double")).alias("vec"))
    V.HELD_NUMBERS, old = 100, V.HELD_NUMBERS
    try:
        assert all(r.vec == [float(r.seq)] for r in V.pool_mean(many).collect())
    finally:
        V.HELD_NUMBERS = old


def test_all_pairs_above_a_floor(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(100, 16))
    x = centers[rng.integers(0, 100, 10_000)] + rng.normal(size=(10_000, 16)) * 0.01
    x[17] = x[4000] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "query_id long, vec array<double>").repartition(8)
    got = {(r.query_id, r.doc_id): r.score for r in V.cosine_matrix(df, upper=True, floor=0.9999).collect()}
    unit = V._unit(x)
    s = V._similarity(unit, unit)
    i, j = np.nonzero(np.triu(s >= 0.9999, 1))
    close = {(a, b) for a, b in zip(i.tolist(), j.tolist())}
    assert {p for p in close ^ set(got) if abs(s[p] - 0.9999) > 1e-9} == set() and (17, 4000) in got
    cross = V.cross_cosine(df.filter("query_id < 50"), df.withColumnRenamed("query_id", "doc_id"), rows=64)
    assert cross.count() == 50 * 10_000


@pytest.mark.parametrize("k", [1, 5])
def test_topk_passes_over_far_blocks(spark, k):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 8))
    x = np.repeat(centers, 500, axis=0) + rng.normal(size=(20_000, 8)) * 0.001
    x[5] = 0
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, vec array<double>").repartition(4)
    queries = corpus.filter("doc_id % 97 = 5 OR doc_id = 0").withColumnRenamed("doc_id", "query_id")
    scored = spark.sparkContext.accumulator(0)
    got = {}
    for r in V.topk_similar(queries, corpus, k, max_queries=50, scored=scored).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.doc_id
    unit = V._unit(x)
    for q, found in got.items():
        s = np.round(V._similarity(unit[q : q + 1], unit)[0], 12)
        want = sorted(range(len(s)), key=lambda i: (-s[i], i))[:k]
        assert [found[i + 1] for i in range(k)] == want
    assert len(got) == queries.count() and scored.value < len(got) * len(x)


def test_directions_have_their_closed_form_and_any_width(spark):
    u = np.arange(1, 20_001, dtype=float)
    rows = [(layer, ((-1) ** i * (i + 1) * u[: 20_000 if layer else 7]).tolist()) for layer in (0, 1) for i in range(3)]
    got = {r.layer: np.array(r.vec) for r in C.direction_pca(spark.createDataFrame(rows, "layer int, vec array<double>")).collect()}
    for layer, v in got.items():
        np.testing.assert_allclose(v, u[: len(v)] / np.linalg.norm(u[: len(v)]), atol=1e-12)
    assert len(got[0]) == 7 and len(got[1]) == 20_000


def test_directions_of_close_eigenvalues(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 60)) * np.linspace(1, 1.2, 60)
    df = spark.createDataFrame([(0, r.tolist()) for r in x] + [(1, [0.0, 0.0])], "layer int, vec array<double>").repartition(4)
    got = {r.layer: np.array(r.vec) for r in C.direction_pca(df).collect()}
    values, vectors = np.linalg.eigh(x.T @ x)
    assert abs(got[0] @ vectors[:, -1]) > 1 - 1e-6 and abs(np.linalg.norm(got[1]) - 1) < 1e-12


# sequences and texts


def test_long_common_runs(spark):
    rng = random.Random(5)
    a, b = [rng.randrange(97) for _ in range(100_000)], [rng.randrange(97) for _ in range(100_000)]
    b[70_000:71_234] = a[5_000:6_234]
    b[69_999], b[71_234] = 500, 500
    df = spark.createDataFrame([(1, a, b), (2, None, b), (3, [], []), (4, [1], [1]), (5, [1, 2], [3])], "i int, a array<int>, b array<int>")
    out = W.longest_common_run(df, "a", "b")
    assert {r.i: r.run for r in out.select("i", "run").collect()} == {1: 1234, 2: 0, 3: 0, 4: 1, 5: 0}
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_cutting_takes_linear_time(spark):
    took = {}
    for n in (2_000, 4_000, 20_000):
        df = spark.createDataFrame([(f"w{i} " * n,) for i in range(8)], "t string")
        for _ in range(2):
            start = time.perf_counter()
            df.select(F.size(T.pretokenize("t"))).collect()
            took[n] = time.perf_counter() - start
    assert took[20_000] < 10 * max(took[4_000], 0.3)


def test_every_family_keeps_the_text(spark):
    texts = ["", "a", "It's 12345 o'clock,  isn't\n\n it?\t ", "﷐﷑x", "日本語テキスト 한국어 <sentinel:3>IMGIMGABZ", "x" * 5000 + " " * 5000 + "\n" * 50, "1234567 ABCdef !!??", "é‍😀  z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for family in [*T.PRETOKENIZERS, "mpt"]:
        for r in df.select("t", T.pretokenize("t", family).alias("p")).collect():
            assert "".join(r.p) == r.t and "" not in r.p, family


# shards and commits


def test_one_whole_shard_is_full(spark):
    rows = P.shuffle_shards(spark.range(8).withColumnRenamed("id", "idx"), 8)
    assert {r.full for r in P.assign_batches(rows, 1).collect()} == {True}
    short = P.shuffle_shards(spark.range(7).withColumnRenamed("id", "idx"), 8)
    assert {r.full for r in P.assign_batches(short, 1).collect()} == {False}


def test_a_long_chain_of_commits(spark, monkeypatch):
    n = 10_000
    edges = [(f"c{i}", f"c{i + 1}") for i in range(n)] + [("c10", "side"), ("side", "c9000"), ("other", "c5"), ("c3", None)]
    rounds = []
    original = B.written
    monkeypatch.setattr(B, "written", lambda df, what: rounds.append(what) or original(df, what))
    got = {r.commit: r.depth for r in B.ancestors(spark.createDataFrame(edges, "commit string, parent string"), "c0").collect()}
    assert len(rounds) < 30 and rounds.count("depths") < 20
    assert got == {**{f"c{i}": i if i < 9000 else i - 9000 + 12 for i in range(1, n + 1)}, "side": 11}


def test_ancestors_of_random_histories(spark):
    rng = random.Random(12)
    edges = sorted({(i, rng.randint(i + 1, i + 4)) for i in range(60) for _ in range(rng.randint(1, 2))})
    depth, layer = {0: 0}, [0]
    while layer:
        layer = sorted({p for c, p in edges if c in layer} - set(depth))
        depth |= {p: depth_of + 1 for depth_of in [max(depth.values())] for p in layer}
    got = {r.commit: r.depth for r in B.ancestors(spark.createDataFrame(edges, "commit long, parent long"), 0).collect()}
    assert got == {c: d for c, d in depth.items() if d}


def odd_docs(n, seed):
    rng = random.Random(seed)
    pool = ["a", "bb", "longer", "\x01", "x\x02n", "", None, "längst", "word"]
    return [(i, [rng.choice(pool) for _ in range(rng.randint(0, 12))]) for i in range(n)] + [(n, None)]


@pytest.mark.parametrize("sizes", [(2, 2), (1, 4), (2, 4), (3, 3)])
def test_dealt_counts_equal_plain_ones(spark, sizes):
    docs = odd_docs(80, 5)
    flat = N.ngram_flat(spark.createDataFrame(docs, "doc_id long, tokens array<string>"), *sizes)
    want = {}
    for _, toks in docs:
        for i, n in ((i, n) for i in range(len(toks or [])) for n in range(sizes[0], min(sizes[1], i) + 1)):
            # A context that begins with a missing token is taken for one that is too short.
            if toks[i] is not None and toks[i - n] is not None:
                key = (n, *[None] * (4 - n), *toks[i - n : i + 1])
                want[key] = want.get(key, 0) + 1
    assert {(r.n, r.p4, r.p3, r.p2, r.p1, r.token): r.cnt for r in flat.collect()} == want


def test_few_counts_pick_the_static_ones_they_ask_for(spark, capsys):
    prompts = spark.createDataFrame(odd_docs(30, 6), "prompt_id long, tokens array<string>")
    docs = spark.createDataFrame(odd_docs(200, 7), "doc_id long, tokens array<string>")
    own, static = N.ngram_flat(prompts, 2, 4, keep=("prompt_id",)), N.ngram_flat(docs, 2, 2)
    both = [N.ngram_predict_validated(own, static, keep=("prompt_id",), parts=8, few=few) for few in (False, True)]
    rows = [sorted(str(tuple(r)) for r in df.collect()) for df in both]
    assert rows[0] == rows[1] != []
    both[1].explain()
    assert "LeftSemi" in capsys.readouterr().out  # before the union and its sort


def test_words_of_a_text_are_not_looked_up_one_by_one(spark):
    docs = spark.createDataFrame(odd_docs(5, 8), "doc_id long, tokens array<string>")
    plan = N.ngram_flat(docs, 2, 2, parts=8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 1  # of the tokens that have to be written otherwise
