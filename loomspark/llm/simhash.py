"""Near duplicates by SimHash.

Only distinct fingerprints are compared.  A fingerprint is split into blocks; two that differ in at most ``bits`` bits agree
in all but ``bits`` blocks, so pairs meet on the values of ``blocks - bits`` blocks and are verified by their bits.
A crowd of near copies would meet in all pairs, so links are found in two steps.  First each fingerprint is compared
with one leader of every block value it has, and what that links is one component.  Then only fingerprints of different
components are compared, and of those only pairs with a side outside the largest component of the block value: a
pair within a component needs no link, and every other pair is such a pair.  Both steps together find every link
between components, so the components are exact.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import map_rows
from loomspark.plans.scratch import written

SHINGLE = 4
BITS = 4
SEED = 42
#: Members of a block value from which on leaders of longer values are tried as well; only work depends on it.
CROWD = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each the majority of that bit in the hashes of all shingles; 0 without a word."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[size:]] + [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, key: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The ``key`` columns and fp (the fingerprint as a signed long) of each row."""
    kinds = dict(docs.dtypes)
    narrow = docs.select(*key, F.col(text))
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in key) + ", fp long"
    return map_rows(narrow, lambda: lambda *row: (*row[:-1], _signed(fingerprint(row[-1], shingle))), schema)


def masks(blocks: int, used: int) -> list[int]:
    """Masks of every choice of ``used`` of the blocks that 64 bits are cut in."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, used)]


def _keyed(nodes: DataFrame, chosen: list[int]) -> DataFrame:
    """A row for each node and mask: table, value and the node's columns."""
    keys = F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for t, m in enumerate(chosen)])
    return nodes.select("*", F.explode(keys).alias("k")).select("k.table", "k.value", *nodes.columns)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _led(nodes: DataFrame, chosen: list[int], what: str) -> DataFrame:
    """(table, value, fp, n, leader, members) for nodes whose block value others share; the leader stands for most rows."""
    keyed = _keyed(nodes, chosen)
    groups = keyed.groupBy("table", "value").agg(F.count(F.lit(1)).alias("members"), F.max(F.struct("n", "fp")).alias("top"))
    busy = written(groups.filter("members > 1").select("table", "value", "members", F.col("top.fp").alias("leader")), what)
    return keyed.join(busy, ["table", "value"])


def components(edges: DataFrame, what: str) -> DataFrame:
    """(node, root) of the connected components of edges (a, b); the root is the smallest node.

    Each round every node points to its smallest neighbour, pointers are followed to their ends by doubling, and
    the graph is contracted; a round at least halves the nodes of every component, so rounds grow with the logarithm.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    spark = edges.sparkSession
    edges = written(edges.select(low.alias("a"), high.alias("b")).filter("a < b").distinct(), what)
    whole = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), what)
        while True:
            nexts = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = written(roots.join(nexts, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), what)
            roots = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if whole is None:
            whole = roots
        else:
            later = roots.select(F.col("node").alias("root"), F.col("root").alias("later"))
            whole = written(whole.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root")), what)
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        moved = edges.join(a, "a").join(b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = written(moved.filter("a < b").distinct(), what)
    return whole if whole is not None else spark.createDataFrame([], "node long, root long")


def linked(nodes: DataFrame, bits: int = BITS, blocks: int | None = None) -> DataFrame:
    """(node, root) of every fingerprint of ``nodes`` (fp, n) that is linked to another, by links of at most ``bits`` bits.

    ``blocks`` sets how much is compared, never what is found: more blocks mean longer values that fewer share, and more
    copies of each fingerprint.  Unset, they follow the number of fingerprints.
    """
    nodes = written(nodes.select("fp", "n"), "nodes")
    if blocks is None:
        count = nodes.count()
        blocks = bits + (2 if count < 1 << 25 else 3 if count < 1 << 31 else 4)
    led = written(_led(nodes, masks(blocks, blocks - bits), "busy"), "led")
    near = lambda x: x.filter((F.col("fp") != F.col("leader")) & (_distance(F.col("fp"), F.col("leader")) <= bits))
    edges = near(led).select(F.col("fp").alias("a"), F.col("leader").alias("b"))
    crowded = written(led.filter(F.col("members") >= CROWD).select("fp", "n").distinct(), "crowded")
    finer = [m for used in range(blocks - bits + 1, blocks) for m in masks(blocks, used)]
    edges = edges.unionByName(near(_led(crowded, finer, "busy")).select(F.col("fp").alias("a"), F.col("leader").alias("b")))
    first = written(components(edges, "first"), "first")
    own = first.select(F.col("node").alias("fp"), "root")
    parts = written(led.select("table", "value", "fp").join(own, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "parts")
    sizes = parts.groupBy("table", "value", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("table", "value")
    tops = written(sizes.agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("size", "root")).alias("top")).filter("roots > 1").select("table", "value", F.col("top.root").alias("top")), "tops")
    mixed = written(parts.join(tops, ["table", "value"]), "mixed")
    one = mixed.filter("root != top").select("table", "value", F.col("fp").alias("x"), F.col("root").alias("a"))
    other = mixed.select("table", "value", F.col("fp").alias("y"), F.col("root").alias("b"))
    meets = (one["table"] == other["table"]) & (one["value"] == other["value"]) & (F.col("a") != F.col("b")) & (_distance(F.col("x"), F.col("y")) <= bits)
    second = components(one.join(other, meets).select("a", "b"), "second").select(F.col("node").alias("root"), F.col("root").alias("later"))
    alone = second.join(first, second["root"] == first["node"], "left_anti").select(F.col("root").alias("node"), F.col("later"))
    moved = first.join(second, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return moved.unionByName(alone.select("node", F.col("later").alias("root")))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, text_hash, fp and component_id (the smallest doc_id that is reachable) of each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other.  Null ids stay and are never the smallest; a component
    of null ids only has a null component_id.  Rows that repeat each give a row; of equal fingerprints one is compared.
    An empty table gives an empty table; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"), F.col(text).alias("text"))
    seen = written(fingerprints(rows, ["doc_id", "text_hash"], "text", shingle), "fingerprints")
    nodes = written(seen.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "lows")
    roots = written(linked(nodes, bits), "roots").select(F.col("node").alias("fp"), "root")
    grouped = written(nodes.join(roots, "fp"), "grouped")
    lows = written(grouped.groupBy("root").agg(F.min("low").alias("component_id")), "components")
    named = written(grouped.select("fp", "root").join(lows, "root").select("fp", "component_id", F.lit(True).alias("linked")), "named")
    all_named = written(nodes.join(named, "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("low")).alias("component_id")), "all-named")
    return seen.join(all_named, "fp", "left").select("doc_id", "text_hash", "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their component: one row with the smallest id, with all its columns.

    Of rows that share that id the one with the smallest text hash stays, and one of those that are equal in both; of a
    component without ids the one with the smallest text hash stays, once.
    """
    seen = near_duplicates(docs, text, doc_id, shingle, bits)
    own = seen.withColumn("component", F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string"))))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    stay = written(own.groupBy("component").agg(first.alias("k")).select("k.id", "k.hash"), "stay")
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), h.cast("string"))
    keyed = docs.withColumn("__key", key(F.col(doc_id).cast("long"), F.coalesce(F.xxhash64(text), F.lit(0))))
    kept = keyed.join(stay.select(key(F.col("id"), F.col("hash")).alias("__key")).distinct(), "__key", "left_semi")
    return kept.dropDuplicates(["__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
