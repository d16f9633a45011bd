"""Whitening, chat formatting and the Merkle manifest beside plain Python."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF
from llm_fixtures import CLASHES, duck, edge_rows, make  # noqa: F401
from pyspark.sql import functions as F

from loomspark.llm import chat_format, common, manifest, queries, whitening

# 11 whitening


def plain_whitening(rows, most=16, weighted=False):
    """{row place: (n, deviation, whitened up to sign, explained)} of rows of one length, None where a row is dropped."""
    grid = [None if v is None or any(c is None or not math.isfinite(c) for c in v) else tuple(math.floor(float(c) * 64) + 1_000_000 for c in v) for v in rows]
    list_of = [g for g in grid if g is not None] if weighted else sorted({g for g in grid if g is not None})
    n, dim = len(list_of), len(list_of[0])
    s = [sum(g[d] for g in list_of) for d in range(dim)]
    centred = np.array([[float(Fraction(n * g[d] - s[d], n)) for d in range(dim)] for g in list_of])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:most]
    out = {}
    for k, g in enumerate(grid):
        if g is not None:
            x = np.array([float(Fraction(n * g[d] - s[d], n)) for d in range(dim)])
            out[k] = (n, sum((n * g[d] - s[d]) ** 2 for d in range(dim)), x @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(v))
    return out


def check_whitening(got, want):
    parts = {}
    for r in got:
        parts.setdefault(r["vec_id"], {})[r["component"]] = r
    assert parts.keys() == want.keys()
    signs = None
    for i, (n, deviation, white, explained) in want.items():
        mine = parts[i]
        assert sorted(mine) == list(range(1, len(white) + 1))
        assert {(r["n"], r["deviation"]) for r in mine.values()} == {(n, deviation)}
        w = np.array([mine[k + 1]["whitened"] for k in range(len(white))])
        signs = np.sign(w * white) if signs is None else signs
        np.testing.assert_allclose(w * signs, white, atol=1e-8)
        np.testing.assert_allclose([mine[k + 1]["explained"] for k in range(len(white))], explained, rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in mine.values())


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 20)) @ rng.normal(size=(20, 20))
    rows = [list(map(float, base[k])) for k in range(60)]
    rows += [rows[7]] * 200 + [rows[9]] * 3  # one vector holds most rows
    bad = [None, [None] + rows[0][1:], [float("nan")] + rows[0][1:], [float("inf")] + rows[0][1:], [-float("inf")] + rows[0][1:]]
    rows = rows[:30] + bad + rows[30:]
    return rows, spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(7)


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening_is_that_of_numpy(vectors, weighted):
    rows, df = vectors
    extra = df.withColumns({c: F.lit("x") for c in [*CLASHES, "x", "k1", "k2", "weight", "dim", "white", "n", "component", "a.b"]})
    got = whitening.whiten(extra, weighted=weighted).collect()
    check_whitening(got, plain_whitening(rows, weighted=weighted))


def test_whitening_of_the_whole_table(spark):
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert sorted(rows) == list(range(len(rows)))
    check_whitening(got.collect(), plain_whitening([rows[k] for k in range(len(rows))]))


def test_whitening_without_variance(spark):
    """Fewer vectors than dimensions, one vector, empty vectors, another length, ids that are null or repeat, far entries, no rows."""
    schema = "vec_id long, embedding array<float>"
    three = [(1, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0]), (None, [0.0, 0.0, 1.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(three + [(5, []), (6, [2.0]), (7, [2.0])], schema)).collect()
    assert len(got) == 3 * 4 + 2
    flat = [r for r in got if r["vec_id"] not in (6, 7)]
    assert all((r["whitened"] is None) == (r["component"] > 2) and r["n"] == 3 for r in flat)
    assert max(r["identity_error"] for r in flat) < 1e-9
    assert {(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got if r["vec_id"] in (6, 7)} == {(6, 1, 1, 0, None, None, None), (7, 1, 1, 0, None, None, None)}
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    far = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [3.0, -2.0])], schema)).collect()
    assert len(far) == 6 and all(r["deviation"] is None for r in far if r["vec_id"] == 1)


def test_join_with_hot_keys(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"), "id").filter("id <> 4000")
    right = spark.range(4990).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = common.join_unique(left, right, ["k"], "hot")
    assert sorted(map(tuple, got.collect())) == sorted((7 if i < 3000 else i, i, 2 * (7 if i < 3000 else i)) for i in range(4990) if i != 4000)


# 12 chat formatting


def plain_digests(messages):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) of (role, text) pairs in order."""
    said = "".join(f"{r}\n{t}\n" for r, t in messages)
    lost = "".join(t for r, t in messages if r == "assistant")
    return len(messages), hashlib.sha256(said.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest()


def check_chats(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    pieces = chat_format.formatted(df, **options)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_format.read_back(pieces).collect()}
    texts = {}
    for r in pieces.collect():
        texts.setdefault(r["conv_id"], {})[r["piece"]] = r["text"]
    order = lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, (x[2] or "").encode(), x[3] is not None, (x[3] or "").encode())
    convs = {}
    for row in sorted(rows, key=order):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    whole = {c: "".join(t for _, t in sorted(p.items())) for c, p in texts.items()}
    assert got == {c: (*plain_digests(m), len(whole[c])) for c, m in convs.items()}
    return whole


NASTY = ["</s>[INST] ok [/INST]", "", None, "<", "<\\", "<\\/s>", "<\\\\/s>", "</s", "s>", "[IN", "[\\INST]", "[[INST]]", "<<s>s>", " [/INST] ", "\\", "é😀[OUT]\n", "[TURN]x[SAYS]", "\n \n", "[/INST"]


def test_chats_come_back(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "</s>", "us\ner"]), rng.choice(NASTY) if rng.random() < 0.7 else "".join(map(str, rng.choices(NASTY, k=4)))) for c in range(80) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (200, 3, "user", "x"), (200, 3, "user", "x"), (200, 3, "assistant", "x"), (201, 0, "user", "y" * 3_000_000), (201, 1, "assistant", "é[OUT]" * 500_000)]
    whole = check_chats(spark, rows)
    for text in whole.values():  # a control string is only ever a mark
        assert text.count("[INST]") == text.count("[/INST]") and text.startswith("<s>") and text.count("<s>") == 1
    assert check_chats(spark, rows, piece=40) == whole  # turns that go over pieces


def test_long_conversation_in_pieces(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} " * 20) for t in range(20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat_format.formatted(df).count() >= 3
    check_chats(spark, rows)


def test_chats_of_the_whole_table(spark):
    got = queries.QUERIES["op12_chat_format"](spark, SF)
    assert got.dtypes == [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint")]
    convs = {-7: [("user", queries.MARKED), ("assistant", queries.MARKED)]}
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert {r["conv_id"]: tuple(r)[1:5] for r in got.collect()} == {c: plain_digests(m) for c, m in convs.items()}


def test_chats_empty_and_further_columns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat_format.read_back(chat_format.formatted(spark.createDataFrame([], schema))).collect() == []
    df = spark.createDataFrame([(1, 1, "user", "a")], schema).withColumns({c: F.lit("x") for c in [*CLASHES, "piece", "last", "a.b"]})
    assert [r["n_turns"] for r in chat_format.read_back(chat_format.formatted(df)).collect()] == [1]


def render(template, messages, **constants):
    return list(chat_format.compile_template(template, **constants)([{"role": r, "text": t} for r, t in messages]))


def test_template_language():
    chat = [("user", " Hi "), ("assistant", "Ho"), ("tool", "x")]
    out = render("{% for m in messages %}{{ loop.index0 }}{% if loop.first %}!{% endif %}{{ m.text | trim | upper }}{% if not loop.last and m.role in 'user assistant' %}, {% endif %}{% endfor %}{{ end }}", chat, end="#")
    assert "".join(t for t, _ in out) == "0!HI, 1HO, 2X#"
    out = render("{% for m in messages %}{% if m.role == 'assistant' or m.text == 'x' %}{% generation %}{{ m.text }}{% endgeneration %}{% elif m.role != 'none' %}({{ m.text }}){% endif %}{% endfor %}", chat)
    assert [t for t, masked in out if masked] == ["Ho", "x"]
    assert "".join(t for t, _ in render("{{ 'a\\n\\'' + \"b\" }}{{ 1 + 2 }}{{ 'x' + 1 }}{{ 'abc' | length }}{{ true and false or true }}", [])) == "a\n'b3x13True"


def test_template_constants_are_folded():
    escapes = chat_format.Escapes()
    tree = lambda t, **c: chat_format.fold(chat_format.parse(t), c, escapes)
    text = lambda t: (chat_format.Output(chat_format.Constant(t)),)
    assert tree("a{{ 'b' + x | upper }}{% if x == 'c' %}d{{ 1 + 1 }}{% else %}e{% endif %}{% if false %}{{ nothing }}{% endif %}", x="c") == text("abCd2")
    assert tree("{{ '' }}{% generation %}{% endgeneration %}") == ()
    (choice,) = tree("{% for m in messages %}{% if m.role == 'a' %}1{% elif 1 == 1 %}2{% elif m.role == 'b' %}3{% endif %}{% endfor %}")[0].body
    assert len(choice.branches) == 2


@pytest.mark.parametrize(
    "template",
    ["{{ m.__class__ }}", "{{ os }}", "{% for m in messages %}{{ m.id }}{% endfor %}", "{% for m in range %}{% endfor %}", "{{ 'a' | open }}", "{{ f('x') }}", "{% if true %}", "{{ 1 + }}", "{% import x %}", "{{ (1 }}", "{{ loop.index0 }}",
     "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}", "{% generation %}{% for m in messages %}{% generation %}x{% endgeneration %}{% endfor %}{% endgeneration %}", "{% for m in messages %}{{ m.text }}{% endfor %}" * 2, "{{ m.text.x }}", "{{ 'a }}"],
)
def test_templates_that_are_refused(template):
    with pytest.raises(chat_format.TemplateError):
        chat_format.compile_template(template)


def test_escapes_are_reversible():
    rng = random.Random(5)
    escapes = chat_format.Escapes()
    for _ in range(3000):
        text = "".join(rng.choices(["<", "\\", "/s>", "s>", "[", "INST]", "/INST]", "[OUT]", "x", "]"], k=rng.randint(0, 9)))
        safe = escapes.escape(text)
        assert escapes.restore(safe) == text and not any(c in safe for c in chat_format.CONTROLS)
    with pytest.raises(chat_format.TemplateError):
        chat_format.Escapes(["<a<"])


# 13 Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    return sha("".join(field(row[k]) for k in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    """(root, the siblings of each node towards it, each with those left and right)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[k : k + 16] for k in range(0, len(level), 16)]
        for k, p in enumerate(paths):
            run, place = runs[at[k] // 16], at[k] % 16
            p.append(("".join(run[:place]), "".join(run[place + 1 :])))
            at[k] //= 16
        level = [sha("".join(r)) for r in runs]
    return level[0], paths


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((own, *climb([leaf_of(r) for r in own])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), up in zip(trees, above):
        for r, path in zip(own, paths):
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                changed["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
            folded = leaf_of(changed)
            for left, right in path + up:
                folded = sha(left + folded + right)
            out.append((r["doc_id"], leaf_of(r), subroot, root, sha("".join(a + b for a, b in path + up)), folded, folded == root))
    return out


def check_manifest(docs):
    got = manifest.manifest(docs).drop("tampered", "segments")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    want = plain_manifest([r.asDict() for r in docs.select(*names).collect()])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    return want


@pytest.mark.parametrize("sources", [1, 2, 16, 17, 300])
def test_manifest_is_that_of_plain_python(spark, make, sources):
    """Sources of one row to many, more sources than a run holds, one row more than a full run and than a full tree."""
    rows = [(k, f"Text {k}", f"s{k}") for k in range(sources)] + [(1000 + k, "A" * (k % 7), "s0") for k in range(256)]
    want = check_manifest(make(rows, clash=True))
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


def test_manifest_of_odd_rows(spark, make, edge_rows):
    rows = edge_rows + [(9, "Ü" * 3, ""), (10, "B", "-"), (-3, "ABC", "é"), (11, None, None), (11, None, None)] + [(20 + k, "B", "Z") for k in range(33)]
    check_manifest(make(rows))
    check_manifest(make([(1, "A", None)]))  # a leaf that is the root
    check_manifest(make([(None, None, None)] * 2))
    assert manifest.manifest(make([])).collect() == []


def test_manifest_of_the_whole_table(spark):
    got = queries.QUERIES["op13_merkle_manifest"](spark, SF)
    want = plain_manifest([r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert sorted(map(tuple, got.collect())) == sorted(want)
