"""Benchmark decontamination by templates.

Words become typed placeholders where a question can be re-parameterised: numbers, measures (a number with its unit), units
behind a number, and names (words with a capital first letter that are not common sentence openers).  Windows of eight
template words are joined by hash, and beside them windows of the words as they are, in lower case.  Before a window of a document
is hashed, two of its words have to be a pair that a window of the items has at that place: a window of an item names its longest
pair of plain words that stand together, and what equals the window holds that pair.  So pairs are looked up for every word of
every text, and windows are cut where a pair is met.

Where a document and an item meet, the values behind the placeholders are compared.  Along one alignment each name of the
item has to stand for one name of the document, and windows with another one do not count; numbers, measures and units
have to be consistent within a window.  Windows with equal words count in any case.  A verbatim copy passes with equal
values, a re-parameterised question with replaced ones, a chance meeting fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.plans.scratch import written

WINDOW = 8
#: Items of fewer words are too short to be evidence: a document may say "the end" by itself.  ``too_short`` lists them.
MIN_ITEM = 5
#: Words of a window that are not placeholders, at least.
MIN_PLAIN = 4
#: An item is found if half its windows are, or this many (13 words in a row).
MIN_SHARE_PERCENT = 50
MIN_WINDOWS = 6
#: Item windows that are broadcast have no more rows and bytes than this; beyond it what they meet is shuffled.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
NO_ID = -(1 << 63)
MAX_INT = (1 << 31) - 1
TOKEN = r"([\p{L}\p{N}]+(?:[.,:/'’-][\p{L}\p{N}]+)*)"
UNITS = "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur percent degrees kmh mph".split()
OPENERS = "the a an and or but if of in on at to for from by with as is are was were be it this that these those he she they we you i his her their its what which who whom whose when where why how there here let find given suppose each all some no not after before then so do does did can could will would should may le la les un une des du de et en au aux il elle der die das ein eine und in zu von mit den dem ist el los las un una y que con".split()


def tokens(text: Column) -> Column:
    """Words and numbers of a text without the marks around them."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 1)


def templates(words: Column) -> Column:
    """Each word as it stands in a template; ``words`` has to be a plain column."""

    digit = lambda w: F.ascii(w).between(48, 57)

    def one(w, i):  # the cheap test comes first, as nearly every word is plain
        low = F.lower(w)
        name = (w != low) & (F.substring(w, 2, MAX_INT) == F.substring(low, 2, MAX_INT)) & ~low.isin(OPENERS)
        return (
            F.when(digit(w), F.when(w.rlike(r"^[0-9][0-9.,:/-]*$"), F.lit("<n>")).otherwise(F.lit("<m>")))
            .when(digit(F.coalesce(F.get(words, i - 1), F.lit(""))) & low.isin(UNITS), F.lit("<u>"))
            .when(~F.ascii(w).between(97, 122) & name, F.lit("<p>"))
            .otherwise(low)
        )

    return F.transform(words, one)


def _plain(word: Column) -> Column:
    return ~F.startswith(word, F.lit("<"))


def lowered(words: Column) -> Column:
    return F.transform(words, F.lower)


def _pair_hash(gap: int | Column, a: Column, b: Column) -> Column:
    return F.xxhash64(gap if isinstance(gap, Column) else F.lit(gap), a, b)


def _anchor(words: Column, free: Column) -> Column:
    """(gap, offset, hash) of the pair that stands for a window: its words are ``free`` of placeholders, near each other, and long."""

    def pairs(gap):
        spots = F.sequence(F.lit(0), F.size(words) - gap - 1)
        one = lambda i: F.struct(F.lit(-gap).alias("near"), (F.length(F.get(words, i)) + F.length(F.get(words, i + gap))).alias("long"), (-i).alias("early"))
        return F.transform(F.filter(spots, lambda i: F.get(free, i) & F.get(free, i + gap)), one)

    best = F.array_max(F.concat(*[pairs(gap) for gap in GAPS]))
    gap, at = -best["near"], -best["early"]
    return F.struct(gap.alias("gap"), at.alias("offset"), _pair_hash(gap, F.get(words, at), F.get(words, at + gap)).alias("pair"))


#: Places from one word of a pair to the other.  A dense window has a pair of plain words at most two apart.
GAPS = (1, 2)


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), tokens(F.col(text)).alias("words"))
    return rows.withColumn("template", templates(F.col("words")))


def too_short(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and n_words of the items that are never found, as they have too few words; those without a word too."""
    rows = _items(items, item_id, text)
    return rows.filter(F.size("words") < MIN_ITEM).select("item_id", F.size("words").cast("long").alias("n_words"))


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, size, at, words, template, form, hash, gap, offset, pair, n_windows): the windows of each item.

    A window is looked for as its words in lower case and, if it holds enough plain words, as its template too; ``form`` is
    what the hash is of, and a window has a row for each of its forms.  An item shorter than a window is one window of
    its own size.  Rows that share an id are windows of one item.
    """
    rows = _items(items, item_id, text).filter(F.size("words") >= MIN_ITEM).withColumn("size", F.least(F.lit(WINDOW), F.size("words")))
    part = lambda c, i: F.slice(c, i + 1, F.col("size")).alias(c)
    cut = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda i: F.struct(i.alias("at"), part("words", i), part("template", i)))
    each = rows.select("item_id", "size", F.explode_outer(cut).alias("x")).select("item_id", "size", "x.*")
    free = F.transform("template", _plain)
    each = each.withColumns({"low": lowered(F.col("words")), "dense": F.size(F.filter(free, lambda x: x)) * WINDOW >= MIN_PLAIN * F.col("size")})
    each = each.withColumn("free", F.when(F.col("dense"), free).otherwise(F.transform("template", lambda w: F.lit(True))))
    each = each.withColumn("anchor", _anchor(F.col("low"), F.col("free")))
    forms = F.when(F.col("dense"), F.array_distinct(F.array("low", "template"))).otherwise(F.array("low"))
    each = each.select("item_id", "size", "at", "words", "template", "anchor.*", F.explode_outer(forms).alias("form")).withColumn("hash", F.xxhash64("form"))
    totals = rows.groupBy("item_id").agg(F.sum(F.size("words") - F.col("size") + 1).alias("n_windows"))
    return each.join(totals, "item_id")


def _spots(rows: DataFrame, gaps: list[int]) -> DataFrame:
    """The columns of ``rows`` (with words), place and pair: the pairs of every place of every text.

    The words are zipped with themselves, shifted, and exploded, so that lower case and hash are compiled code over plain
    columns; the array stays where it is until a pair is met.
    """
    shifted = [F.slice("words", gap + 1, F.lit(MAX_INT)).alias(f"w{gap}") for gap in gaps]
    each = rows.select("*", F.posexplode_outer(F.arrays_zip(F.col("words").alias("w0"), *shifted)).alias("place", "w"))
    pairs = [_pair_hash(gap, F.lower(F.col("w.w0")), F.lower(F.col(f"w.w{gap}"))) for gap in gaps]
    found = pairs[0] if len(pairs) == 1 else F.explode(F.array(*pairs))
    return each.select(*rows.columns, "place", found.alias("pair"))


def find(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text_hash, item_id, n_found and n_windows (windows of the item found, and in all) of each item a document holds.

    Only documents with a finding have rows, one for each item; rows that repeat count as one document; null ids
    stay; null and empty texts hold nothing; an item of fewer than five words is never found (``too_short`` lists these); one of
    placeholders is found by its words only.  A share that ties with the limit is a finding.  Empty tables give an
    empty table; other columns are not read.  Item windows are broadcast while they are few in rows and bytes, else pairs are
    shuffled; what is joined further grows with the findings.
    """
    bench = written(item_windows(items, item_id, item_text), "item-windows")
    length = F.octet_length(F.array_join(F.concat("words", "template", "form"), "  "))
    rows, volume, gaps = bench.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0)), F.sort_array(F.collect_set("gap"))).first()
    few = rows <= broadcast_rows and volume <= BROADCAST_BYTES
    anchors = bench.groupBy("pair").agg(F.collect_set(F.struct("size", "offset")).alias("starts"))
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    keys = ["doc_id", "text_hash"]
    read = lambda x: x.withColumn("words", tokens(F.col("text")))
    start = (F.col("place") - F.col("s.offset")).alias("start")
    if few:
        # In one pass: a pair meets the anchors in memory, and only where it does is a window cut out of the text.
        hit = _spots(read(texts).select(*keys, "words"), gaps or [1]).join(F.broadcast(anchors), "pair")
        hit = hit.select(*keys, "words", "place", F.explode("starts").alias("s")).select(*keys, "words", start, "s.size")
    else:
        # In two: pairs are shuffled to the anchors, and the documents that met one are read once more for their words.
        hit = _spots(read(texts).select(*keys, "words"), gaps or [1]).select(*keys, "place", "pair").join(anchors, "pair")
        hit = hit.select(*keys, "place", F.explode("starts").alias("s")).select(*keys, F.struct(start, "s.size").alias("x"))
        by_doc = written(hit.groupBy(*keys).agg(F.collect_set("x").alias("xs")), "spots")
        hit = read(texts.join(by_doc, keys)).select(*keys, "words", F.explode("xs").alias("x")).select(*keys, "words", "x.start", "x.size")
    inside = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.size("words"))
    # A window with the word before it, which tells a unit.
    before = F.array(F.coalesce(F.get("words", F.col("start") - 1), F.lit("")))
    cut = hit.filter(inside).select(*keys, "start", "size", F.concat(before, F.slice("words", F.col("start") + 1, F.col("size"))).alias("near"))
    behind = lambda c: F.slice(c, F.lit(2), F.lit(WINDOW))
    seen = cut.withColumn("shape", templates(F.col("near"))).select(*keys, "start", "size", behind(F.col("near")).alias("seen"), behind(F.col("shape")).alias("seen_template"))
    seen = seen.withColumn("seen_low", lowered(F.col("seen")))
    hashed = seen.select("*", F.explode(F.array_distinct(F.array(F.xxhash64("seen_template"), F.xxhash64("seen_low")))).alias("hash"))
    windows = bench.select("item_id", "n_windows", "at", "words", "template", "form", "hash")
    met = hashed.join(F.broadcast(windows) if few else windows, "hash")
    # Equal forms, not only equal hashes.
    met = met.filter((F.col("seen_template") == F.col("form")) | (F.col("seen_low") == F.col("form")))
    return _consistent(met, keys)


def _consistent(met: DataFrame, keys: list[str]) -> DataFrame:
    """The findings among windows that met: those whose values agree."""
    same = lowered(F.col("words")) == F.col("seen_low")
    slot = F.zip_with("template", F.zip_with(lowered(F.col("words")), "seen_low", lambda a, b: F.struct(a.alias("item"), b.alias("doc"))), lambda t, p: F.struct(t.alias("kind"), p["item"].alias("item"), p["doc"].alias("doc")))
    placed = F.transform(slot, lambda p, i: F.struct(p["kind"].alias("kind"), p["item"].alias("item"), p["doc"].alias("doc"), (F.col("at") + i).alias("pos")))
    row = ["doc_id", "text_hash", "item_id", "n_windows"]
    table = met.select(*row, (F.col("start") - F.col("at")).alias("shift"), "at", same.alias("same"), F.filter(placed, lambda p: ~_plain(p["kind"])).alias("slots")).distinct()
    table = written(table, "met-windows")
    # Numbers, measures and units: one value of the item has one value in the window.
    values = F.transform(F.filter("slots", lambda p: p["kind"] != "<p>"), lambda p: F.struct(p["kind"].alias("kind"), p["item"].alias("item"), p["doc"].alias("doc")))
    steady = F.size(F.array_distinct(values)) == F.size(F.array_distinct(F.transform(values, lambda v: F.struct(v["kind"].alias("kind"), v["item"].alias("item")))))
    names = F.filter("slots", lambda p: p["kind"] == "<p>")
    table = table.withColumns({"steady": steady, "names": names}).drop("slots")
    # Names: along an alignment the value that most places of a name have stands for it; of equal numbers none does.
    line = [*keys, "item_id", "shift"]
    each = table.select(*line, F.explode("names").alias("p")).select(*line, "p.item", "p.doc", "p.pos").distinct()
    counts = each.groupBy(*line, "item", "doc").agg(F.count(F.lit(1)).alias("n"))
    tops = counts.groupBy(*line, "item").agg(F.max(F.struct("n", "doc")).alias("top"), F.count(F.lit(1)).alias("values"), F.sort_array(F.collect_list("n"), asc=False).alias("ns"))
    clear = (F.col("values") == 1) | (F.get("ns", F.lit(0)) > F.get("ns", F.lit(1)))
    stands = tops.filter(clear).select(*line, "item", F.col("top.doc").alias("doc"))
    held = table.filter("NOT same AND steady AND size(names) > 0").select(*row, "shift", "at", F.size("names").alias("n_names"), F.explode("names").alias("p"))
    held = held.select(*row, "shift", "at", "n_names", F.col("p.item").alias("item"), F.col("p.doc").alias("doc")).join(stands, [*line, "item", "doc"])
    agreed = held.groupBy(*row, "shift", "at").agg(F.max("n_names").alias("n_names"), F.count(F.lit(1)).alias("n")).filter("n = n_names").select(*row, "at")
    left = table.filter("same OR (steady AND size(names) = 0)").select(*row, "at").unionByName(agreed)
    found = left.distinct().groupBy(*row).agg(F.count(F.lit(1)).alias("n_found"))
    enough = (F.col("n_found") * 100 >= F.col("n_windows") * MIN_SHARE_PERCENT) | (F.col("n_found") >= MIN_WINDOWS)
    back = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return found.filter(enough).select(back, "text_hash", "item_id", "n_found", "n_windows")


def _list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in dict.fromkeys(words)) + ")"


def _sql(table: str, key: str, sizes: str) -> str:
    """DuckDB: (key, n, size, at_, words, low, template) of the windows of a table, of each of ``sizes``."""
    token = TOKEN.replace("'", "''")
    number = "regexp_matches({}, '^[0-9]')"
    return rf"""t_{table} AS (SELECT {key}, regexp_extract_all(coalesce(text, ''), '{token}', 1) AS ws FROM {table}),
p_{table} AS (SELECT {key}, ws, list_transform(ws, lambda w: lower(w)) AS lo, list_transform(ws, lambda w, i: CASE WHEN {number.format('w')} THEN CASE WHEN regexp_matches(w, '^[0-9][0-9.,:/-]*$') THEN '<n>' ELSE '<m>' END
    WHEN lower(w) IN {_list(UNITS)} AND i > 1 AND {number.format('ws[i - 1]')} THEN '<u>'
    WHEN w <> lower(w) AND substring(w, 2) = substring(lower(w), 2) AND lower(w) NOT IN {_list(OPENERS)} THEN '<p>' ELSE lower(w) END) AS tp FROM t_{table}),
w_{table} AS (SELECT {key}, len(ws) AS n, size, at_, lo[at_ : at_ + size - 1] AS low, tp[at_ : at_ + size - 1] AS template FROM (
  SELECT {key}, ws, lo, tp, size, unnest(range(1, len(ws) - size + 2)) AS at_ FROM p_{table}, {sizes} WHERE len(ws) >= size))"""


ORACLE = rf"""WITH {_sql('benchmark', 'item_id', f"(SELECT unnest(range({MIN_ITEM}, {WINDOW} + 1)) AS size)")},
own AS (SELECT *, len(list_filter(template, lambda w: NOT starts_with(w, '<'))) * {WINDOW} >= {MIN_PLAIN} * size AS dense FROM w_benchmark WHERE n >= {MIN_ITEM} AND size = least(n, {WINDOW})),
b AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_windows FROM own),
sizes AS (SELECT DISTINCT size FROM b),
{_sql('documents', 'doc_id', 'sizes')},
m AS (SELECT DISTINCT doc_id, item_id, n_windows, shift, at_, same, tp, bl, dl FROM (
  SELECT doc_id, item_id, n_windows, d.at_ - b.at_ AS shift, b.at_ AS at_, b.low = d.low AS same, b.template AS tp, b.low AS bl, d.low AS dl FROM w_documents d JOIN b ON d.template = b.template WHERE b.dense
  UNION ALL SELECT doc_id, item_id, n_windows, d.at_ - b.at_, b.at_, true, b.template, b.low, d.low FROM w_documents d JOIN b ON d.low = b.low)),
s AS (SELECT doc_id, item_id, shift, at_, at_ + i AS pos, tp[i] AS kind, bl[i] AS v, dl[i] AS x FROM (SELECT *, unnest(range(1, len(tp) + 1)) AS i FROM m) WHERE starts_with(tp[i], '<')),
uneven AS (SELECT DISTINCT doc_id, item_id, shift, at_ FROM s WHERE kind <> '<p>' GROUP BY doc_id, item_id, shift, at_, kind, v HAVING count(DISTINCT x) > 1),
names AS (SELECT doc_id, item_id, shift, v, x, count(DISTINCT pos) AS c FROM s WHERE kind = '<p>' GROUP BY ALL),
beaten AS (SELECT a.* FROM names a WHERE EXISTS (SELECT 1 FROM names o WHERE o.doc_id = a.doc_id AND o.item_id = a.item_id AND o.shift = a.shift AND o.v = a.v AND o.x <> a.x AND o.c >= a.c)),
wrong AS (SELECT DISTINCT s.doc_id, s.item_id, s.shift, s.at_ FROM s JOIN beaten USING (doc_id, item_id, shift, v, x) WHERE s.kind = '<p>' UNION SELECT * FROM uneven),
f AS (SELECT doc_id, item_id, n_windows, count(DISTINCT at_) AS n_found FROM m LEFT JOIN (SELECT *, true AS bad FROM wrong) USING (doc_id, item_id, shift, at_) WHERE same OR bad IS NULL GROUP BY doc_id, item_id, n_windows)
SELECT doc_id, item_id, n_found, n_windows FROM f WHERE n_found * 100 >= n_windows * {MIN_SHARE_PERCENT} OR n_found >= {MIN_WINDOWS}"""
