"""Operators over whole tables, and the pipeline."""

import math
import random
import re
from collections import Counter
from math import comb

import pytest
import xxhash
from compare import compare
from conftest import SF
from llm_fixtures import duck, edge_rows, make  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from loomspark.llm import decontamination, html_extraction, line_dedup, packing, quality_rules, queries, sharding, simhash

# 3 SimHash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    """Index of the first reachable entry for each entry of ``prints``."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("blocks", [None, 5, 7])
def test_links_are_exact(spark, blocks):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for center in [rng.getrandbits(64) for _ in range(4)]:  # crowds, chains and stragglers
        for _ in range(90):
            x = center
            for b in rng.sample(range(24), rng.randint(0, 7)):
                x ^= 1 << b * 2
            prints.add(x)
            prints.add(x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    prints = sorted(prints)
    nodes = spark.createDataFrame([(simhash._signed(p), rng.randint(1, 3)) for p in prints], "fp long, n long")
    got = {r.node: r.root for r in simhash.linked(nodes, blocks=blocks).collect()}
    want = plain_components(prints)
    groups, mine = {}, {}
    for p, w in zip(prints, want):
        groups.setdefault(w, set()).add(p)
        mine.setdefault(got.get(simhash._signed(p), simhash._signed(p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_near_duplicates_rows(make, edge_rows):
    rows = [*edge_rows, (20, " ".join(f"w{k}" for k in range(80)), "z"), (None, None, "z")]
    got = simhash.near_duplicates(make(rows, clash=True)).collect()
    key = lambda i: -1 if i is None else i
    want = plain_components([plain_fingerprint(t) for _, t, _ in rows])
    low = {}
    for (i, _, _), w in zip(rows, want):
        if i is not None:
            low[w] = min(low.get(w, i), i)
    assert sorted((key(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == sorted((key(i), plain_fingerprint(t), low[w]) for (i, t, _), w in zip(rows, want))
    stay = simhash.one_of_each(make(rows, clash=True))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(low.values())) and "fp" in stay.columns
    assert simhash.near_duplicates(make([])).collect() == []
    assert len(simhash.one_of_each(make([(None, "a b c", "x"), (None, "a b c", "x")])).collect()) == 1


def test_components_of_a_long_path(spark):
    ids = random.Random(1).sample(range(-500, 500), 300)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r.root for r in simhash.components(edges, "path").collect()} == {min(ids)}


# 4 sharding


def test_shards(make, edge_rows):
    rows = edge_rows * 30
    docs = make(rows, clash=True).repartition(7)
    out = sharding.shuffle(docs, shards=5).collect()
    assert sorted(str((r.doc_id, r.text)) for r in out) == sorted(str((i, t)) for i, t, _ in rows)
    sizes = Counter(r.shard for r in out)
    assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    assert sharding.shuffle(make([])).collect() == []


def test_matrix_has_its_sums():
    counts, sizes = [5, 0, 17, 200, 1], sharding.shard_sizes(223, 24)
    m = sharding.communication_matrix(counts, sizes, 3)
    assert [sum(r) for r in m] == counts and [sum(c) for c in zip(*m)] == sizes


@pytest.mark.parametrize("library_rows", [0, 10**9])
def test_matrix_has_its_law(library_rows):
    """Every cell of many tables against the exact chances of a uniform permutation, with either sampler."""
    counts, sizes, n = [5, 0, 7, 3], [6, 5, 4], 4000
    seen = [[Counter() for _ in sizes] for _ in counts]
    for seed in range(n):
        matrix = sharding.communication_matrix(counts, sizes, seed, library_rows)
        assert [sum(r) for r in matrix] == counts and [sum(c) for c in zip(*matrix)] == sizes
        for row, cells in zip(matrix, seen):
            for x, c in zip(row, cells):
                c[x] += 1
    total = sum(sizes)
    for k, cells in zip(counts, seen):
        for size, c in zip(sizes, cells):
            for x in range(min(k, size) + 1):
                p = comb(size, x) * comb(total - size, k - x) / comb(total, k)
                assert abs(c[x] - n * p) < 5 * (n * p * (1 - p)) ** 0.5 + 1


def test_chances_keep_their_digits():
    from fractions import Fraction

    for good, bad, draws in ((40, 60, 30), (1, 99, 50), (1000, 9000, 777), (3, 3, 6)):
        share = draws / (good + bad)
        for x in range(max(0, draws - bad), min(good, draws) + 1):
            exact = Fraction(comb(good, x) * comb(bad, draws - x), comb(good + bad, draws))
            if 0 < share < 1 and exact > Fraction(1, 10**300):
                got = sharding._binomial(x, good, share) + sharding._binomial(draws - x, bad, share) - sharding._binomial(draws, good + bad, share)
                assert abs(math.exp(got) / float(exact) - 1) < 1e-9
    # of a trillion rows: neighbours of the mode have the quotient that their counts say
    good, bad, draws = 41_666_666_667, 958_333_333_333, 1_000_000
    share = draws / (good + bad)
    mode = (draws + 1) * (good + 1) // (good + bad + 2)
    chance = lambda x: sharding._binomial(x, good, share) + sharding._binomial(draws - x, bad, share)
    assert abs(math.exp(chance(mode + 50) - chance(mode)) / math.prod((good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1)) for k in range(mode, mode + 50)) - 1) < 1e-9
    rng = random.Random(1)
    drawn = [sharding.hypergeometric(good, bad, draws, rng) for _ in range(300)]
    assert abs(sum(drawn) / 300 - draws * good / (good + bad)) < 60


def test_hypergeometric_law():
    rng = random.Random(9)
    got = Counter(sharding.hypergeometric(7, 9, 6, rng) for _ in range(20_000))
    for k in range(7):
        assert abs(got[k] / 20_000 - comb(7, k) * comb(9, 6 - k) / comb(16, 6)) < 0.012


# 9 packing


def brute_cost(histogram, buckets):
    lengths = sorted(histogram)
    best = {0: 0}
    for _ in range(buckets):
        new = {}
        for j in range(1, len(lengths) + 1):
            new[j] = min((best[i] + lengths[j - 1][0] * sum(n for _, n in lengths[i:j]) for i in best if i < j), default=None)
        best = {0: 0} | {j: c for j, c in new.items() if c is not None}
        yield best.get(len(lengths))


def test_bounds_are_optimal():
    rng = random.Random(6)
    for _ in range(300):
        histogram = [(x, rng.randint(1, 9)) for x in rng.sample(range(60), rng.randint(1, 14))]
        for buckets in (1, 2, 4):
            tops = packing.bounds(histogram, buckets)
            cost = sum(n * min(t for t in tops if t >= x) for x, n in histogram)
            assert len(tops) <= buckets and cost == min(c for c in brute_cost(histogram, buckets) if c is not None)


def test_packing_rows(make, edge_rows):
    rows = edge_rows * 3
    out = packing.pack(make(rows, clash=True), packing.word_length(), budget=500).collect()
    assert len(out) == len(rows)
    for (b, k), batch in {(r.bucket, r.batch): [x for x in out if (x.bucket, x.batch) == (r.bucket, r.batch)] for r in out}.items():
        assert len(batch) * batch[0].bucket_len <= 500 or len(batch) == 1
        assert sorted(r.place for r in batch) == list(range(len(batch)))
        assert all(r.n_tokens <= r.bucket_len for r in batch)
    assert packing.pack(make([]), packing.word_length()).collect() == []


def test_one_long_row_does_not_round_the_others(make):
    lengths = [1, 2, 3, 5, 7, 11, 13, 400_000]
    out = packing.pack(make([(n, "x" * n, "a") for n in lengths]), F.length("text")).collect()
    assert sorted((r.n_tokens, r.bucket_len) for r in out) == [(n, n) for n in lengths]


# 5 HTML extraction


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)

    def length(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(2000):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = html_extraction.shared(a, b)
        rest = iter(b)
        assert sum(got) == length(a, b) and all(x in rest for x, g in zip(a, got) if g)


@pytest.mark.parametrize(
    "page, text",
    [
        ('<body><header>Site</header><div id="menu">m</div><main><article><header><h1>Title &amp; x</h1><i>me</i></header><p>One<b>two</b> three<br>four &nbsp; five</p><aside>s</aside><form>f</form><div class="cookie-notice">c</div><p>End</article><section class="comments"><article class="comment"><p>r</p></article></section></main><footer>f</footer>', "Title & x Onetwo three four five End"),
        ('<article>Head<div class="ad">ad<p>x</div>tail <span class="ads">zz</span>end<img src="a>b">.</article><script>"</p>"</script>', "Head tail end."),
        ('<html class="has-sidebar"><body class="comments-open"><article class="post comments-off"><p>x</p></article>', "x"),
        ("<p>a < b &lt;i&gt; &#233; &bogus;</p>", "a < b <i> é &bogus;"),
        ("<!-- c -->\n<style>p{}</style>", ""),
        ("<p title=it's>one</p><p title='a>b'>two's</p>", "one two's"),
        ("plain", "plain"),
        (None, ""),
    ],
)
def test_blocks(spark, page, text):
    pages = spark.createDataFrame([(1, None, page)], "page_id long, url string, html string")
    assert html_extraction.extract(pages).first()["text"] == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='content-sidebar-wrap'><article><p>story</p></article><div class='widget-area'>w</div></div>", "story"),
        ("<div class='post-with-comments'><article><p>story</p></article><div class='post-comments'><article>reply</article></div></div>", "story"),
        ("<div>chrome text that is longer than it</div><div class='layout-menu-left'><main><p>story</p></main></div>", "chrome text that is longer than it story"),
        ("<form><div class='top-menu'>m</div><p>A page that stands in one form</p><input name=x></form>", "A page that stands in one form"),
        ("<p>A long story of the page</p><form>search</form><div class='share-box'>s</div>", "A long story of the page"),
        ("<article>long story</article><div class='related-posts'><article>card</article></div>", "long story"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "So x=2 holds"),
    ],
)
def test_names_alone_do_not_drop_the_article(page, text):
    found = html_extraction.blocks(page)
    marked = any(i for _, i in found)
    assert " ".join(t for t, i in found if i or not marked) == text


def test_neighbours_lose_shared_lines(spark):
    row = lambda k, url, body: (k, url, f"<div>Home</div><div>About</div>{body}<div>Bottom</div>", "x")
    rows = [row(k, f"http://h.example/blog/{k}", f"<p>own {k}</p>") for k in range(40)]
    rows += [row(90, "http://h.example/other", "<p>own 90</p>"), row(91, "http://alone.example/", "<p>own 91</p>"), row(None, "http://[bad", "<p>z</p>")]
    rows += [row(3, "http://h.example/blog/3", "<p>own 3</p>"), (92, None, "<article><p>kept</p></article><p>gone</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lines string").repartition(5)
    out = [(r.page_id, r.text) for r in html_extraction.extract(pages).collect()]
    assert len(out) == len(rows)
    assert all((k, f"own {k}") in out for k in [*range(40), 90]) and out.count((3, "own 3")) == 2
    assert (91, "Home About own 91 Bottom") in out and (92, "kept") in out
    assert html_extraction.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_copies_do_not_delete_each_other(spark, parts):
    page = lambda body: f"<div>Home</div>{body}<div>Bottom</div>"
    rows = [(k, f"http://h.example/a/{k:03d}", page("<p>same story</p>")) for k in range(30)]
    rows += [(50, "http://h.example/a/zz", page("<p>other story</p>")), (60, "http://only.example/1", page("<p>s</p>")), (61, "http://only.example/2", page("<p>s</p>"))]
    rows += [(70 + k, f"http://m.example/{k}", page(f"<div>story {k}</div><article class=teaser>card {k}</article>")) for k in range(3)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {k: "same story" for k in range(30)} | {50: "other story", 60: "Home s Bottom", 61: "Home s Bottom"} | {70 + k: f"story {k} card {k}" for k in range(3)}


@pytest.mark.parametrize("page", ["<" * 50_000, "<b>" * 50_000, "<div>" * 50_000, "<b><p>" * 30_000, '<div class="' * 20_000, "<p>x" * 50_000])
def test_odd_markup_ends(page):
    html_extraction.blocks(page)


# the pipeline


def test_pipeline_against_plain_steps(spark, duck):
    docs = duck(SF).execute("SELECT * FROM documents").df()
    keep = duck(documents=docs).execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").df()["doc_id"]
    docs = docs[docs["doc_id"].isin(keep)]
    docs = duck(documents=docs).execute(f"SELECT doc_id, text, lang, source, len(text) AS n_chars FROM ({line_dedup.ORACLE}) ORDER BY doc_id").df()
    first = plain_components([plain_fingerprint(t) for t in docs["text"]])
    docs = docs[[k == w for k, w in enumerate(first)]]
    leaks = duck(SF, documents=docs).execute(f"SELECT doc_id FROM ({decontamination.ORACLE})").df()["doc_id"]
    docs = docs[~docs["doc_id"].isin(leaks)]
    assert compare(corpus_pipeline.run(spark, SF), duck(documents=docs), packing.ORACLE) == ""


def test_stages_keep_columns_and_survive_odd_rows(spark, make, edge_rows):
    for docs in (make(edge_rows, clash=True), make([])):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            if k + 1 < len(corpus_pipeline.STAGES):
                assert docs.columns == corpus_pipeline.COLUMNS, name


def test_registered(spark):
    import __spark_entry__ as entry

    names = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)", q)[1]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
    sharded = queries.QUERIES["op4_sharding"](spark, SF)
    assert sharded.agg(F.countDistinct("shard")).first()[0] == 24
