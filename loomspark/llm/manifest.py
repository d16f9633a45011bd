"""Merkle manifest of a dataset: a digest of every row, a tree for each source, a tree over the sources, and a proof for each row.

Rows are ranked within their source over all tasks; runs of sixteen consecutive nodes become a node until a tree has one.
A node knows the digests left and right of it in its run: its segment towards its parent.  Proofs come by pointer
jumping: each round joins the nodes to the nodes that they point at, appends those segments and points twice as far, so the rounds
grow with the logarithm of the height.  Only nodes above the rows jump; the sixteen rows of a run then take the
segments of their parent in one join, so that what all of them share travels once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import join_unique, ranked
from loomspark.plans.scratch import written

ARITY = 16
#: Rows whose copy is altered, to show that the proof notices: those whose crc32 of the id this divides.
TAMPER_EVERY = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The columns that a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The tree over the sources; no source has this key, as theirs is empty (null) or begins with a letter.
TOP = "\x00"
SEGMENTS = "array<struct<left:binary,right:binary,own:boolean>>"


def field(value: Column) -> Column:
    """A value as a leaf reads it: its length in bytes and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def tree_key(source: Column) -> Column:
    """A key without null that sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """tree, doc_id, leaf and changed (the leaf of the altered copy, null where a row is not altered), all read in one pass."""
    doc_id, source, *_, text = [F.col(f"`{c}`") for c in fields]
    columns = [F.col(f"`{c}`") for c in fields]
    lowered = F.translate(text.cast("string"), UPPER, UPPER.lower())
    tampered = F.crc32(doc_id.cast("string")) % TAMPER_EVERY == 0
    return docs.select(
        tree_key(source).alias("tree"),
        doc_id.cast("long").alias("doc_id"),
        F.unhex(leaf(columns)).alias("leaf"),
        F.unhex(F.when(tampered, leaf([*columns[:-1], lowered]))).alias("changed"),
    )


def _hex(b: Column) -> Column:
    return F.lower(F.hex(b))


def _all(members: Column) -> Column:
    """The digests of members, in their order, as bytes."""
    return F.unhex(F.array_join(F.transform(members, lambda m: F.hex(m["digest"])), ""))


def _segment(members: Column, at: Column, own: Column) -> Column:
    """What is left and right of the member at place ``at`` (from 0)."""
    return F.struct(
        _all(F.slice(members, F.lit(1), at)).alias("left"),
        _all(F.slice(members, at + 2, F.lit(ARITY))).alias("right"),
        own.alias("own"),
    )


def _runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """tree, run, members (idx, digest and ``carried``, in order) of nodes (tree, idx, digest, …); a run holds ARITY nodes at most."""
    member = F.struct("idx", "digest", *carried)
    grouped = nodes.groupBy("tree", F.floor(F.col("idx") / ARITY).cast("long").alias("run")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    return grouped.withColumn("digest", F.unhex(F.sha2(_hex(_all(F.col("members"))), 256)))


#: A first run of one node is a whole tree of one node: a longer tree has more in its first run.
ALONE = "run = 0 AND size(members) = 1"


def _climb(nodes: DataFrame, own: bool, level: int) -> tuple[DataFrame, list[DataFrame]]:
    """Tops (tree, level, digest) of the trees that ``nodes`` (tree, idx, digest) of a level build, and a table of hops for each level.

    A hop is a node (tree, level, idx) with its segment and the place of its parent.  A level is a sixteenth of the one below.
    """
    tops, hops = None, []
    while True:
        runs = written(_runs(nodes), "runs")
        done = runs.filter(ALONE).select("tree", F.lit(level).alias("level"), F.get("members", F.lit(0))["digest"].alias("digest"))
        tops = done if tops is None else tops.unionByName(done)
        runs = runs.filter(f"NOT ({ALONE})")
        if runs.isEmpty():
            return tops, hops
        each = runs.select("tree", "run", "members", F.posexplode("members").alias("at", "m"))
        hops.append(each.select("tree", F.lit(level).alias("level"), F.col("m.idx").alias("idx"), F.col("run").alias("parent"), F.array(_segment(F.col("members"), F.col("at"), F.lit(own))).alias("segments")))
        nodes, level = runs.select("tree", F.col("run").alias("idx"), "digest"), level + 1


def _pointers(hops: list[DataFrame], tops: DataFrame, upper: list[DataFrame], ranks: DataFrame) -> DataFrame:
    """(tree, level, idx, up_tree, up_level, up_idx, segments) of every node: its parent, or nothing where it is the root."""
    spark = tops.sparkSession
    up = ["up_tree", "up_level", "up_idx"]
    none = [F.lit(None).cast(k).alias(c) for c, k in zip(up, ("string", "int", "long"))]
    parts = [h.select("tree", "level", "idx", F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("parent").alias("up_idx"), "segments") for h in [*hops, *upper]]
    # The top of a source is a node of the tree over the sources under another name; it hops as that one does.
    if upper:
        as_node = ranks.select(F.col("source_tree").alias("tree"), "level", F.col("idx").alias("place")).join(upper[0].select(F.col("idx").alias("place"), "parent", "segments"), "place")
        parts.append(as_node.select("tree", "level", F.lit(0).cast("long").alias("idx"), F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"), F.col("parent").alias("up_idx"), "segments"))
        parts.append(spark.range(1).select(F.lit(TOP).alias("tree"), F.lit(len(upper)).alias("level"), F.lit(0).cast("long").alias("idx"), *none, F.array().cast(SEGMENTS).alias("segments")))
    else:
        parts.append(ranks.select(F.col("source_tree").alias("tree"), "level", F.lit(0).cast("long").alias("idx"), *none, F.array().cast(SEGMENTS).alias("segments")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("tree", "level", "idx", *up, "segments")


def _jump(pointers: DataFrame) -> DataFrame:
    """(tree, level, idx, segments up to the root): pointers are followed twice as far in each round until all are at the root.

    Many nodes point at one ancestor, so an ancestor that more than a thousandth of the nodes point at is broadcast.
    """
    up = ["up_tree", "up_level", "up_idx"]
    pointers = written(pointers, "pointers")
    while True:
        going = pointers.filter("up_tree IS NOT NULL")
        if going.isEmpty():
            return pointers.select("tree", "level", "idx", "segments")
        there = pointers.select(*[F.col(c.removeprefix("up_")).alias(c) for c in up], *[F.col(c).alias(f"next_{c}") for c in up], F.col("segments").alias("more"))
        moved = join_unique(going, there, up, "hot-nodes")
        moved = moved.select("tree", "level", "idx", *[F.col(f"next_{c}").alias(c) for c in up], F.concat("segments", "more").alias("segments"))
        pointers = written(moved.unionByName(pointers.filter("up_tree IS NULL")), "pointers")


def _fold(start: Column, segments: Column) -> Column:
    """The hexadecimal digest that a digest (hexadecimal) and the segments above it lead to."""
    return F.aggregate(segments, start, lambda d, s: F.sha2(F.concat(_hex(s["left"]), d, _hex(s["right"])), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered and segments of each row of ``docs``.

    ``fields`` names the columns of a leaf: id, source, …, text.  A null value is ``-``, an empty one ``0:``; rows without a
    source are a source of their own, the first; null ids come first in theirs; rows that share an id are ordered by
    leaf, and equal rows have equal leaves and proofs; a source of one row has that leaf as its subroot, a table of one row
    as its root; an empty table gives an empty table; other columns are not read.  Texts stay in the task that reads
    them.  A source of any size is ranked and built over all tasks.
    """
    rows = ranked(written(leaves(docs, fields), "leaves"), ["tree", "doc_id", "leaf"], "idx", "ranked-leaves", within=["tree"])
    runs = _runs(rows.select("tree", "idx", F.col("leaf").alias("digest"), "doc_id", "changed"), "doc_id", "changed")
    # A source of one row has no level of runs: its leaf is its node already.
    lone = F.expr(ALONE)
    runs = written(runs.withColumns({"lone": lone, "digest": F.when(lone, F.get("members", F.lit(0))["digest"]).otherwise(F.col("digest"))}), "leaf-runs")
    tops, hops = _climb(runs.select("tree", F.col("run").alias("idx"), "digest"), True, 1)
    named = tops.select(F.col("tree").alias("source_tree"), "level", "digest")
    ranks = written(ranked(named, ["source_tree"], "idx", "subroots"), "ranked-subroots")
    peaks, upper = _climb(ranks.select(F.lit(TOP).alias("tree"), "idx", "digest"), False, 0)
    roots = peaks.select("digest").collect()  # one row
    root = F.lit(bytes(roots[0]["digest"]).hex() if roots else None).cast("string")
    paths = _jump(_pointers(hops, tops, upper, ranks)).filter((F.col("tree") != TOP) & (F.col("level") == 1))
    met = runs.join(paths.select("tree", F.col("idx").alias("run"), "segments"), ["tree", "run"])
    met = met.withColumn("subroot", _fold(_hex(F.col("digest")), F.filter("segments", lambda s: s["own"])))
    each = met.select("members", "lone", "segments", "subroot", F.posexplode("members").alias("at", "m"))
    first = F.when(F.col("lone"), F.array().cast(SEGMENTS)).otherwise(F.array(_segment(F.col("members"), F.col("at"), F.lit(True))))
    each = each.select(F.col("m.doc_id").alias("doc_id"), F.col("m.digest").alias("leaf"), F.col("m.changed").alias("changed"), "subroot", F.concat(first, "segments").alias("segments"))
    siblings = F.array_join(F.transform("segments", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    out = each.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        _fold(_hex(F.coalesce("changed", "leaf")), F.col("segments")).alias("folded_root"),
        F.col("changed").isNotNull().alias("tampered"),
        "segments",
    )
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "tampered", "segments")


# The same for DuckDB, over a table ``documents``.  Trees of one node are handed on as they are, so all have one height there.
SQL_LEVELS, SQL_TOP_LEVELS = 6, 4


def _sql_level(table: str, k: int) -> str:
    """Runs of level k of the trees of ``table``, and the nodes above them."""
    return f"""{table}_r{k} AS (SELECT tree, idx // {ARITY} AS run, list(d ORDER BY idx) AS ds, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {table}_{k}) GROUP BY tree, run),
{table}_{k + 1} AS (SELECT tree, run AS idx, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {table}_r{k})"""


def _sql_hop(name: str, source: str, table: str, k: int, tree: str, place: str) -> str:
    """Proof and folded digest, one level on."""
    at = f"({place} // {ARITY**k}) % {ARITY}"
    left, right = f"array_to_string(ds[1 : {at}], '')", f"array_to_string(ds[{at} + 2 :], '')"
    return f"""{name} AS (SELECT p.* EXCLUDE (proof, folded), CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof, CASE WHEN n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded
  FROM {source} p JOIN {table}_r{k} r ON r.tree = p.{tree} AND r.run = p.{place} // {ARITY ** (k + 1)})"""


def _sql() -> str:
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    first = " || ".join(value(c) for c in FIELDS[:-1])
    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    step = "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), {step}), 4294967295)"
    parts = [
        f"""rows_ AS (SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({first} || {value('text')}) AS leaf,
  CASE WHEN {crc} % {TAMPER_EVERY} = 0 THEN sha256({first} || {value(lowered)}) END AS changed FROM documents)""",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows_)",
        "own_0 AS (SELECT tree, idx, leaf AS d FROM leaves)",
        *[_sql_level("own", k) for k in range(SQL_LEVELS)],
        f"subs AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS place FROM own_{SQL_LEVELS})",
        "top_0 AS (SELECT 0 AS tree, place AS idx, d FROM subs)",
        *[_sql_level("top", k) for k in range(SQL_TOP_LEVELS)],
        "path_0 AS (SELECT doc_id, tree, idx, leaf, '' AS proof, coalesce(changed, leaf) AS folded FROM leaves)",
        *[_sql_hop(f"path_{k + 1}", f"path_{k}", "own", k, "tree", "idx") for k in range(SQL_LEVELS)],
        f"up_0 AS (SELECT p.*, s.d AS subroot, s.place, 0 AS top FROM path_{SQL_LEVELS} p JOIN subs s USING (tree))",
        *[_sql_hop(f"up_{k + 1}", f"up_{k}", "top", k, "top", "place") for k in range(SQL_TOP_LEVELS)],
    ]
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.d AS verified FROM up_{SQL_TOP_LEVELS} CROSS JOIN top_{SQL_TOP_LEVELS} t"


ORACLE = _sql()
