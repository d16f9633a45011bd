"""Tokenisers against plain loops on small vocabularies."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from loomspark.operators import ngrams as N
from loomspark.operators import tokens as T


def ids_of(spark, v, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.tokens for r in T.tokenize_corpus(df, v, **kw).collect()}


@pytest.mark.parametrize("family", ["gpt2", "llama3", "default", "tekken", "gpt-4o", "deepseek-coder", "falcon", "superbpe"])
def test_pretokenizers_match_python(spark, family):
    text = "Hello, it's me!  123 4567\n\n naïve café—ok HTTPServer 'LL x\t$$ 12345 "
    want = [text]
    for pattern in T.PRETOKENIZERS[T.ALIASES.get(family, family)]:
        nxt = []
        for p in want:
            at = 0
            for m in regex.finditer(pattern, p):
                nxt += [p[at : m.start()], m.group()]
                at = m.end()
            nxt.append(p[at:])
        want = [x for x in nxt if x]
    got = spark.createDataFrame([(text,)], "t string").select(T.pretokenize("t", family).alias("p")).first().p
    assert got == want


def test_bpe_merges_by_rank_then_left(spark):
    ids = {c: b for b, c in T.BYTE_CHARS.items()}
    ranks = {}
    for a, b in [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "a"), ("aa", "aa")]:
        ranks[(a, b)] = len(ranks)
        ids[a + b] = len(ids)
    v = T.Vocab("bpe", ids, attrs={}, ranks=ranks, family="gpt2")

    def slow(word):
        parts = list(T.byte_text(word))
        while True:
            hits = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
            if not hits:
                return [ids[p] for p in parts]
            _, i = min(hits)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    got = ids_of(spark, v, words, add_special=False)
    assert [got[i] for i in range(60)] == [slow(w) for w in words]


def test_spm_bytes_and_space_prefix(spark):
    names = ["<unk>", "<s>", "</s>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "h", "i", "▁h", "hi", "▁hi"]
    ids = {t: i for i, t in enumerate(names)}
    scores = {i: -float(i) for i in ids.values()}
    attrs = {i: T.ATTR_CONTROL if i < 3 else T.ATTR_BYTE if i < 259 else T.ATTR_NORMAL for i in ids.values()}
    v = T.Vocab("spm", ids, scores, attrs, bos=1, eos=None)
    got = ids_of(spark, v, ["hi é", "", "<s>hi"], parse_special=True)
    name = lambda ts: [names[t] for t in ts]
    assert name(got[0]) == ["<s>", "▁hi", "▁", "<0xC3>", "<0xA9>"]
    assert name(got[1]) == ["<s>"]
    assert name(got[2]) == ["<s>", "<s>", "▁hi"]


def test_wordpiece_drops_whole_words(spark):
    ids = {"[UNK]": 0, "▁un": 1, "able": 2, "▁": 3, "▁,": 4}
    v = T.Vocab("wpm", ids, attrs=dict.fromkeys(ids.values(), T.ATTR_NORMAL), bos=100, sep=101)
    assert ids_of(spark, v, ["Unable, unx ÚNABLE"])[0] == [100, 1, 2, 4, 0, 1, 2, 101]


def test_unigram_takes_the_best_path(spark):
    ids = {"<unk>": 0, "▁": 1, "a": 2, "b": 3, "ab": 4, "▁a": 5, "▁ab": 6}
    scores = {1: -1.0, 2: -1.0, 3: -1.0, 4: -1.5, 5: -1.8, 6: -9.0}
    attrs = {i: T.ATTR_UNKNOWN if i == 0 else T.ATTR_NORMAL for i in ids.values()}
    v = T.Vocab("ugm", ids, {**scores, 0: 0.0}, attrs)
    got = ids_of(spark, v, ["ab", "xyz ab zz"], add_special=False)
    assert got[0] == [1, 4]
    assert got[1] == [1, 0, 1, 4, 1, 0]


def test_special_tokens_strip_blanks(spark):
    df = spark.createDataFrame([("x  <t> y<u>z",)], "t string")
    specials = [(5, "<t>", T.ATTR_USER_DEFINED | T.ATTR_LSTRIP | T.ATTR_RSTRIP), (6, "<u>", T.ATTR_CONTROL)]
    frags = lambda p: [x.text if x.id is None else x.id for x in df.select(T.partition_special("t", specials, p).alias("f")).first().f]
    assert frags(False) == ["x", 5, "y<u>z"]
    assert frags(True) == ["x", 5, "y", 6, "z"]


def test_marks_in_a_text_are_text(spark):
    texts = ["ab\ufdd0cd", "\ufdd112", "\ufdd1x", "\ufdd0\ufdd0<a>\ufdd1\ufdd0\ufdd1 b", "\ufdd1\ufdd0", "<a><ab>c<a", "<ab><a>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    specials = [(7, "<a>", T.ATTR_USER_DEFINED), (8, "<ab>", T.ATTR_USER_DEFINED), (9, ">c", T.ATTR_USER_DEFINED)]
    for row in df.select("t", T.pretokenize("t").alias("p"), T.partition_special("t", specials, False).alias("f")).collect():
        assert "".join(row.p) == row.t and "".join(x.text for x in row.f) == row.t
        assert [x.id for x in row.f if x.id] == {"<a><ab>c<a": [7, 8], "<ab><a>": [8, 7]}.get(row.t, [7] if "<a>" in row.t else [])


def test_bytes_join_before_decoding(spark):
    ids = {f"<0x{b:02X}>": b for b in range(256)}
    v = T.Vocab("spm", ids, attrs=dict.fromkeys(ids.values(), T.ATTR_BYTE), space_prefix=False)
    df = spark.createDataFrame([(1, [0xE2, 0x82, 0xAC])], "doc_id long, tokens array<int>")
    assert T.detokenize(df, v).first().text == "€"


def test_speech_numbers(spark):
    cases = {
        "I have 42 cats, 3.05 dogs": "i|have|forty|two|cats|three|point|zero|five|dogs", "1000001 x_y": "one|million|one|x|y", "0 and 115": "zero|and|one|hundred|fifteen",
        "99999999999 no": "no", "2000000000": "two|billion",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.s for r in df.select("t", T.speech_text("t", "|").alias("s")).collect()}
    assert got == cases


def test_mixed_prompts(spark):
    ids = {chr(b): b + 1 for b in range(256)}
    v = T.Vocab("rwkv", ids, attrs=dict.fromkeys(ids.values(), T.ATTR_NORMAL), bos=900)
    rows = [(1, '"ab"'), (2, "[12, 34]"), (3, '[12, "a", 7]'), (4, '["a", [5, 6], ["b", 9]]'), (5, '["a", 5, "b"]')]
    out = T.tokenize_prompts(spark.createDataFrame(rows, "prompt_id long, j string"), "j", v).collect()
    got = {(r.prompt_id, r.prompt_no): r.tokens for r in out}
    a, b = 98, 99
    assert got == {(1, 0): [900, a, b], (2, 0): [12, 34], (3, 0): [12, a, 7], (4, 0): [900, a], (4, 1): [5, 6], (4, 2): [900, b, 9], (5, 0): [900, a, 5, b]}


def slow_counts(docs, keep=lambda d: None):
    out = {}
    for d, seq in docs:
        for n in range(1, 5):
            for i in range(n, len(seq)):
                part = out.setdefault((keep(d), n, tuple(seq[i - n : i])), {})
                part[seq[i]] = part.get(seq[i], 0) + 1
    return out


def test_drafts_against_a_loop(spark):
    rng = random.Random(4)
    seq = lambda n: [rng.choice("abc") for _ in range(n)]
    prompts, chats, docs = [(i, seq(9)) for i in range(12)], [(i, seq(14)) for i in range(4)], [(i, seq(20)) for i in range(4)]
    frame = lambda rows: spark.createDataFrame(rows, "prompt_id long, tokens array<string>")
    out = N.ngram_draft(frame(prompts), N.ngram_counts(frame(prompts), keep=("prompt_id",)), N.ngram_counts(frame(chats)), N.ngram_static(frame(docs)), 3)
    ctx, dyn, stat = slow_counts(prompts, lambda d: d), slow_counts(chats), slow_counts(docs)

    def gated(parts, key, tail, samples, percent):
        bigram = stat.get((None, 2, tuple(tail[-2:])), {})
        for n in range(min(4, len(tail)), 0, -1):
            part = parts.get((key, n, tuple(tail[-n:])))
            if part:
                tok = min(part, key=lambda t: (-part[t] * (100 * bigram[t] if t in bigram else 1), t))
                if sum(part.values()) >= samples[n - 1] and 100 * part[tok] >= percent[n - 1] * sum(part.values()):
                    return tok
        return None

    def draft(pid, tail):
        got = []
        for _ in range(3):
            tok = gated(ctx, pid, tail, N.LAX_SAMPLES, N.LAX_PERCENT) or gated(dyn, None, tail, N.STRICT_SAMPLES, N.STRICT_PERCENT)
            if tok is None:
                part = stat.get((None, 2, tuple(tail[-2:])), {})
                best = min(part, key=lambda t: (-part[t], t)) if part else None
                if best and sum(part.values()) >= 2 and 100 * part[best] >= 50 * sum(part.values()):
                    tok = best
            if tok is None:
                break
            got.append(tok)
            tail = tail + [tok]
        return got

    assert {r.prompt_id: r.draft for r in out.collect()} == {p: draft(p, s) for p, s in prompts}


def test_acceptance_of_a_repeating_text(spark):
    df = spark.createDataFrame([(1, list("abcdabcdabcdabcdabcdabcdabcdabcdx")), (2, list("abc"))], "doc_id long, tokens array<string>")
    rows = {r.doc_id: (r.drafted, r.accepted) for r in N.draft_acceptance(df, 16, 4).collect()}
    assert rows[2] == (0, 0)
    drafted, accepted = rows[1]
    assert 0 < accepted <= drafted
    assert N.acceptance_report(N.draft_acceptance(df, 16, 4)).first().accept_pct == pytest.approx(100 * accepted / drafted)


def test_frequencies_equal_the_token_table(spark, tables):
    from loomspark.catalog import vocabularies

    v = vocabularies.bpe(tables)
    docs = tables.documents.limit(40)
    table = T.tokenize_corpus(docs, v, add_special=False).select(F.explode("tokens").alias("token_id")).groupBy("token_id").count()
    assert {tuple(r) for r in table.collect()} == {tuple(r) for r in T.token_frequencies(docs, v).collect()}


def test_a_document_is_joined_in_its_row(spark):
    """No shuffle, and the bytes of each row whatever its key: the text comes back over batches of several slices."""
    ids = {chr(b): b + 1 for b in range(256)}
    v = T.Vocab("rwkv", ids, attrs=dict.fromkeys(ids.values(), T.ATTR_NORMAL))
    texts = [f"é{i} " * (i % 5) for i in range(3 * T.SLICE_ROWS)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    out = T.detokenize(T.tokenize_corpus(df, v, add_special=False), v)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(texts))


def test_a_worker_remembers_short_pieces_only(monkeypatch):
    calls = []
    monkeypatch.setitem(T.ENCODERS, "rwkv", lambda v, s: calls.append(s) or [1])
    encode = T._encoder(T.Vocab("rwkv", {"a": 1}))
    for piece in ("short", "x" * 5000) * 3:
        encode(piece)
    assert calls.count("short") == 1 and calls.count("x" * 5000) == 3


def test_a_small_vocabulary_is_sent_to_the_tokens(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, [0, 1, 0])], "doc_id long, tokens array<int>")
        out = T.token_report(df, spark.createDataFrame([(0, bytearray(b"a"))], "token_id int, raw binary"))
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert {(r.pos, r.piece) for r in out.collect()} == {(0, "a"), (1, None), (2, "a")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
