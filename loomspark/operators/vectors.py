"""Chunking, pooling, normalising and similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loomspark.functions import arrays as A
from loomspark.functions.text import split_keep_empty
from loomspark.plans.scratch import written

#: Vectors that are multiplied at once.
BLOCK_ROWS = 1_024
#: Vectors that say which others are neighbours; results do not depend on them.
PIVOTS = 64


# ------------------------------------------------------------------ text chunks


def _chunker(size: int, sep: str):
    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("byte_offset", T.LongType()), T.StructField("chunk", T.StringType())])))
    def cut(texts: pd.Series) -> pd.Series:
        mark = sep.encode()

        def one(text: str) -> list:
            chunks, start, at, raw = [], 0, 0, text.encode()
            while (hit := raw.find(mark, at)) >= 0:
                at = hit + len(mark)
                if at - start > size:
                    chunks.append([start, raw[start:at]])
                    start = at
            if start < len(raw):
                if chunks:
                    chunks[-1][1] += raw[start:]
                else:
                    chunks.append([start, raw[start:]])
            return [{"byte_offset": p, "chunk": c.decode()} for p, c in chunks]

        return texts.map(one)

    return cut


def chunk_text(df: DataFrame, size: int, sep: str = "\n", *, name: str = "filename", text: str = "text") -> DataFrame:
    """``(name, chunk_no, byte_offset, chunk)``: cut after a separator once a chunk has more than ``size`` bytes.

    What is left at the end joins the last chunk.  Offsets are bytes.
    """
    rows = df.select(name, F.posexplode(_chunker(size, sep)(text)).alias("chunk_no", "c"))
    return rows.select(name, "chunk_no", "c.byte_offset", "c.chunk")


# ------------------------------------------------------------------ single vectors


def normalize(vec, p: int = 2) -> Column:
    """Scale a vector: -1 leaves it, 0 divides by max-abs/32760, 2 is Euclidean, other p the p-norm; zero stays zero."""
    a = F.col(vec) if isinstance(vec, str) else vec
    if p == -1:
        return a
    if p == 0:
        norm = F.array_max(F.transform(a, F.abs)) / 32760.0
    elif p == 2:
        norm = F.sqrt(A.sum_sq(a))
    else:
        norm = F.pow(F.aggregate(a, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x), F.lit(float(p)))), F.lit(1.0 / p))
    return A.let(norm, lambda n: F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(0.0)))


def cosine(a, b) -> Column:
    """Cosine in doubles; two zero vectors are alike, one zero vector is unlike anything."""
    na, nb = A.sum_sq(a), A.sum_sq(b)
    return (
        F.when((na == 0) & (nb == 0), 1.0)
        .when((na == 0) | (nb == 0), 0.0)
        .otherwise(A.dot(a, b) / (F.sqrt(na) * F.sqrt(nb)))
    )


# ------------------------------------------------------------------ pooling


#: Numbers that a task holds in sums before it hands them on.
HELD_NUMBERS = 1 << 22


def _grown(old: np.ndarray, size: int) -> np.ndarray:
    return old if len(old) >= size else np.concatenate([old, np.zeros(size - len(old), old.dtype)])


def _add(sums: dict, key, s: np.ndarray, n: np.ndarray) -> int:
    """Add sums and counts of each dimension to those of ``key``; returns the numbers that are held in addition."""
    if key not in sums:
        sums[key] = (s, n)
        return len(s)
    held, count = (_grown(x, len(s)) for x in sums[key])
    more = len(held) - len(sums[key][0])
    held[: len(s)] += s
    count[: len(n)] += n
    sums[key] = (held, count)
    return more


def _batch_sums(keys: pa.Array, vecs: pa.Array) -> Iterator[tuple]:
    """(key, sum and count of each dimension) of the vectors of a batch; null entries count in neither."""
    named = keys.dictionary_encode(null_encoding="encode")
    codes, names = named.indices.to_numpy(zero_copy_only=False), named.dictionary.to_pylist()
    sizes = pc.fill_null(pc.list_value_length(vecs), 0).to_numpy(zero_copy_only=False)
    flat = vecs.flatten()
    there = pc.is_valid(flat).to_numpy(zero_copy_only=False)
    values = np.where(there, pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64), 0.0)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
    for width in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == width)
        rows = rows[np.argsort(codes[rows], kind="stable")]
        cells = starts[rows][:, None] + np.arange(width)[None, :]
        first = np.flatnonzero(np.diff(codes[rows], prepend=-1))
        yield from zip((names[c] for c in codes[rows][first]), np.add.reduceat(values[cells], first, axis=0), np.add.reduceat(there[cells].astype(np.int64), first, axis=0))


def dense_sums(df: DataFrame, key: str, vec: str) -> DataFrame:
    """``(key, s, n)``: sum and count of each dimension over the vectors of a key, as arrays.

    A task adds up what it reads and hands on one dense vector for each key it has, in several parts where the keys need more
    room than ``HELD_NUMBERS``; so a shuffle gets keys x tasks rows, and a key of any size is only ever added up.  Keys are
    then merged in their order, one at a time.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, s array<double>, n array<bigint>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def out(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x), type=f.type) for x, f in zip((sums, (s for s, _ in sums.values()), (n for _, n in sums.values())), arrow)], schema=arrow)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = {}, 0
        for batch in batches:
            for name, s, n in _batch_sums(batch.column(0), batch.column(1)):
                held += _add(sums, name, s, n)
            if held > HELD_NUMBERS:
                yield out(sums)
                sums, held = {}, 0
        if sums:
            yield out(sums)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = {}, 0
        for batch in batches:
            for name, s, n in zip(*(c.to_pylist() for c in batch.columns)):
                if held > HELD_NUMBERS and name not in sums:  # rows are in the order of keys: the others are complete
                    yield out(sums)
                    sums, held = {}, 0
                held += _add(sums, name, np.array(s), np.array(n))
        if sums:
            yield out(sums)

    parts = df.select(F.col(key), F.col(vec)).mapInArrow(partial, schema)
    return parts.repartition(key).sortWithinPartitions(key).mapInArrow(merge, schema)


def pool_mean(df: DataFrame, *, seq: str = "seq", vec: str = "vec") -> DataFrame:
    """Mean vector per sequence, of the entries that are there."""
    mean = F.zip_with("s", "n", lambda s, n: F.when(n > 0, s / n))
    return dense_sums(df, seq, vec).select(seq, mean.alias("vec"))


def pool_cls(df: DataFrame, *, seq: str = "seq", pos: str = "pos", vec: str = "vec") -> DataFrame:
    return df.groupBy(seq).agg(F.min_by(vec, pos).alias("vec"))


def pool_last(df: DataFrame, *, seq: str = "seq", pos: str = "pos", vec: str = "vec") -> DataFrame:
    return df.groupBy(seq).agg(F.max_by(vec, pos).alias("vec"))


def pool_mean_masked(df: DataFrame, n_inst: int, *, seq: str = "seq", pos: str = "pos", vec: str = "vec") -> DataFrame:
    """Unit mean of the tokens behind the instruction."""
    pooled = pool_mean(df.filter(F.col(pos) >= n_inst), seq=seq, vec=vec)
    return pooled.select(seq, normalize("vec", 2).alias("vec"))


def pool_rank(
    df: DataFrame,
    *,
    key: str,
    vec: str,
    dense: np.ndarray | None = None,
    dense_bias: np.ndarray | None = None,
    out: np.ndarray | None = None,
    out_bias: np.ndarray | None = None,
) -> DataFrame:
    """Scores of a ranking head: ``out @ tanh(dense @ x + b) + b2``, or ``out @ x`` without a dense layer."""
    if dense is None and out is None:
        raise ValueError("a ranking head needs a dense layer or an output layer")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(np.float64)
            if dense is not None:
                x = np.tanh(x @ dense.T + (0 if dense_bias is None else dense_bias))
            if out is not None:
                x = x @ out.T + (0 if out_bias is None else out_bias)
            yield pd.DataFrame({key: pdf[key], "scores": list(x)})

    return df.select(key, vec).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, scores array<double>")


# ------------------------------------------------------------------ similarity


def _unit(rows: Sequence) -> np.ndarray:
    m = np.stack(rows).astype(np.float64)
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of unit rows; two zero rows count as alike."""
    s = a @ b.T
    za, zb = ~a.any(axis=1), ~b.any(axis=1)
    if za.any() and zb.any():
        s[np.ix_(za, zb)] = 1.0
    return s


def _stacked(column: pa.Array) -> np.ndarray:
    """The vectors of a column as rows; all have one length."""
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError("vectors have different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


BLOCK = "block long, ids array<{}>, mat binary, width int, centroid array<double>, radius double, zero boolean"


def _blocks(df: DataFrame, key: str, vec: str, rows: int, what: str, pivots: np.ndarray | None = None) -> DataFrame:
    """The vectors as rows of a table that hold up to ``rows`` unit vectors each, with the cone around them.

    With ``pivots`` vectors are put in order of their nearest one first, and a block has one nearest pivot, so that it holds
    neighbours; the order is dealt out in ranges, so copies of one vector fill as many blocks as they need.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    kind = df.schema[key].dataType.simpleString()
    schema = to_arrow_schema(T.StructType.fromDDL(BLOCK.format(kind)))

    def packed(ids: list, unit: np.ndarray, number: int) -> pa.RecordBatch:
        zero = ~unit.any(axis=1)
        mean = unit.sum(axis=0)
        size = np.linalg.norm(mean)
        centroid = mean / size if size > 1e-9 else mean * 0
        radius = float(np.arccos(np.clip((unit[~zero] @ centroid).min(initial=1.0), -1.0, 1.0))) if size > 1e-9 else float(np.pi)
        row = {"block": number, "ids": ids, "mat": unit.astype("<f8").tobytes(), "width": unit.shape[1], "centroid": centroid.tolist(), "radius": radius, "zero": bool(zero.any())}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, cell = TaskContext.get().partitionId() << 32, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            units, cells = _unit(_stacked(batch.column(1))), batch.column(2).to_pylist()
            for key, unit, own in zip(batch.column(0).to_pylist(), units, cells):
                if ids and (len(ids) == rows or own != cell):
                    yield packed(ids, np.stack(held), number)
                    number, ids, held = number + 1, [], []
                cell = own
                ids.append(key)
                held.append(unit)
        if ids:
            yield packed(ids, np.stack(held), number)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = (_unit(_stacked(batch.column(1))) @ pivots.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32())], names=["key", "vec", "cell"])

    narrow = df.select(F.col(key).alias("key"), F.col(vec).alias("vec"))
    if pivots is None:
        placed = narrow.withColumn("cell", F.lit(0))
    else:
        vec_kind = df.schema[vec].dataType.simpleString()
        placed = narrow.mapInArrow(nearest, f"key {kind}, vec {vec_kind}, cell int").repartitionByRange("cell", "key").sortWithinPartitions("cell")
    return written(placed.mapInArrow(pack, BLOCK.format(kind)), what)


def _bound(left: tuple, right: tuple) -> float:
    """The largest cosine that a vector of one block can have with one of another: ``(centroid, radius, zero)`` of both."""
    angle = float(np.arccos(np.clip(np.dot(left[0], right[0]), -1.0, 1.0))) - left[1] - right[1]
    best = 1.0 if angle <= 0 else float(np.cos(min(angle, np.pi)))
    if left[2] or right[2]:
        best = max(best, 0.0, 1.0 if left[2] and right[2] else 0.0)
    return best + 1e-9  # the centroids are rounded


def _reach(unit: np.ndarray, block: dict) -> np.ndarray:
    """The largest cosine that each unit vector can have with one of a block."""
    centroid, radius, zero = _cone(block)
    angle = np.arccos(np.clip(unit @ centroid, -1.0, 1.0)) - radius
    best = np.cos(np.clip(angle, 0.0, np.pi))
    none = ~unit.any(axis=1)
    if zero or none.any():
        best = np.where(none, 1.0 if zero else 0.0, np.maximum(best, 0.0) if zero else best)
    return best + 1e-9  # the centroids are rounded


def _grid(left: DataFrame, right: DataFrame, same: bool) -> DataFrame:
    """Every block of ``left`` beside every block of ``right``, as columns l_… and r_….

    The blocks of a side are dealt out in groups and a cell is a group of each side, so a block is copied once for each
    group of the other side; there are about as many cells as tasks.  With ``same`` both sides are one table, and a pair of
    blocks is met once.
    """
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n_left, n_right = max(left.count(), 1), max(right.count(), 1)
    if same:
        g_left = g_right = min(n_left, math.ceil(math.sqrt(2 * tasks)))
    else:
        g_left = min(n_left, max(1, round(math.sqrt(tasks * n_left / n_right))))
        g_right = min(n_right, -(-tasks // g_left))

    def side(df, tag, groups, others):
        group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
        own = df.withColumn("__g", group)
        start, stop = (F.col("__g"), F.lit(others - 1)) if same and tag == "l" else (F.lit(0), F.col("__g")) if same else (F.lit(0), F.lit(others - 1))
        each = own.withColumn("__o", F.explode(F.sequence(start, stop)))
        cell = [F.col("__g").alias("gl"), F.col("__o").alias("gr")] if tag == "l" else [F.col("__o").alias("gl"), F.col("__g").alias("gr")]
        return each.select(*cell, *[F.col(c).alias(f"{tag}_{c}") for c in df.columns])

    met = side(left, "l", g_left, g_right).join(side(right, "r", g_right, g_left), ["gl", "gr"])
    if same:
        met = met.filter((F.col("gl") < F.col("gr")) | (F.col("l_block") <= F.col("r_block")))
    return met.drop("gl", "gr")


def _each_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """The two blocks of each row, matrices unpacked when asked for."""
    for batch in batches:
        for row in batch.to_pylist():
            yield tuple({c: row[f"{tag}_{c}"] for c in ("block", "ids", "mat", "width", "centroid", "radius", "zero")} for tag in "lr")


def _matrix(block: dict) -> np.ndarray:
    return np.frombuffer(block["mat"], "<f8").reshape(len(block["ids"]), -1)


def _cone(block: dict) -> tuple:
    return np.array(block["centroid"]), block["radius"], block["zero"]


def _cosines(queries: DataFrame, docs: DataFrame, floor: float | None, rows: int, same: bool, upper: bool = False) -> DataFrame:
    left = _blocks(queries, "query_id", "vec", rows, "query-blocks")
    right = left if same else _blocks(docs, "doc_id", "vec", rows, "doc-blocks")
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def out(q: dict, d: dict, s: np.ndarray) -> pa.RecordBatch:
        i, j = np.nonzero(s >= floor) if floor is not None else (x.ravel() for x in np.indices(s.shape))
        q_ids, d_ids = pa.array(q["ids"], arrow.field(0).type), pa.array(d["ids"], arrow.field(1).type)
        return pa.RecordBatch.from_arrays([q_ids.take(pa.array(i)), d_ids.take(pa.array(j)), pa.array(s[i, j])], schema=arrow)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, d in _each_pair(batches):
            if floor is not None and _bound(_cone(q), _cone(d)) < floor:
                continue
            s = _similarity(_matrix(q), _matrix(d))
            yield out(q, d, s)
            if same and q["block"] != d["block"]:
                yield out(d, q, s.T)

    found = _grid(left, right, same).mapInArrow(multiply, schema)
    return found.filter(F.col("query_id") < F.col("doc_id")) if upper else found


def cross_cosine(queries: DataFrame, docs: DataFrame, *, floor: float | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, doc_id, score)`` for every document against every query, or of the pairs of ``floor`` or more.

    ``queries(query_id, vec)``, ``docs(doc_id, vec)``.  Vectors are multiplied in blocks; with a floor, blocks whose
    cones are too far apart are not, and what comes out is as long as what is alike.
    """
    return _cosines(queries, docs, floor, rows, False)


def cosine_matrix(df: DataFrame, *, upper: bool = False, floor: float | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, doc_id, score)`` of all pairs of one set, or of those of ``floor`` or more; ``upper`` keeps id < id.

    Each pair of blocks is multiplied once.
    """
    same = df.select("query_id", "vec")
    return _cosines(same, same.withColumnRenamed("query_id", "doc_id"), floor, rows, True, upper)


def _pivots(corpus: DataFrame) -> np.ndarray | None:
    """Unit vectors to order a corpus by: those with the smallest hashes of their ids, one for each full block and ``PIVOTS`` at most."""
    there = corpus.filter("vec IS NOT NULL")
    wanted = min(PIVOTS, max(1, there.count() // BLOCK_ROWS))
    rows = there.select("vec").orderBy(F.xxhash64("doc_id")).limit(wanted).collect()
    return _unit([r.vec for r in rows]) if rows else None


def topk_similar(queries: DataFrame, corpus: DataFrame, k: int, *, max_queries: int = BLOCK_ROWS, scored=None) -> DataFrame:
    """The ``k`` nearest corpus vectors of each query: ``(query_id, doc_id, score, rank)``, ties by id.

    Blocks of queries (``max_queries`` each) meet blocks of neighbours of the corpus.  A task keeps the best k of each of
    its queries, and a query passes over a block whose cone cannot hold a better one than the worst of these; a second
    top-k merges the tasks.  ``scored``, an accumulator, counts the pairs that were multiplied.
    """
    pivots = _pivots(corpus)
    q_type, d_type = queries.schema["query_id"].dataType.simpleString(), corpus.schema["doc_id"].dataType.simpleString()
    schema = f"query_id {q_type}, doc_id {d_type}, score double"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    left = _blocks(queries, "query_id", "vec", max_queries, "query-blocks", pivots)
    right = _blocks(corpus, "doc_id", "vec", BLOCK_ROWS, "corpus-blocks", pivots)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}  # block of queries -> ids, scores and documents of the best so far, the best first
        pairs = 0
        for batch in batches:
            # The nearest blocks first: what is found there says early what others have to beat.
            for q, c in sorted(_each_pair([batch]), key=lambda x: -float(np.dot(x[0]["centroid"], x[1]["centroid"]))):
                if q["block"] not in kept:
                    shape = (len(q["ids"]), 0)
                    kept[q["block"]] = (q["ids"], np.empty(shape), np.empty(shape, np.array(c["ids"]).dtype))
                ids, scores, docs = kept[q["block"]]
                unit = _matrix(q)
                rows = np.flatnonzero(_reach(unit, c) >= scores[:, k - 1]) if scores.shape[1] == k else np.arange(len(ids))
                if not len(rows):
                    continue
                pairs += len(rows) * len(c["ids"])
                # equal vectors rank by id, whatever the order of summation
                found = np.round(_similarity(unit[rows], _matrix(c)), 12)
                own = np.broadcast_to(np.array(c["ids"]), found.shape)
                top, names = _top(*(np.concatenate(x, axis=1) for x in ((scores[rows], found), (docs[rows], own))), k)
                if len(rows) == len(ids):
                    kept[q["block"]] = (ids, top, names)
                else:
                    docs = docs.astype(np.promote_types(docs.dtype, names.dtype))  # texts may be longer
                    scores[rows], docs[rows] = top, names
                    kept[q["block"]] = (ids, scores, docs)
        if scored is not None:
            scored.add(pairs)
        for ids, scores, docs in kept.values():
            queries_ = pa.array([i for i in ids for _ in range(scores.shape[1])], arrow.field(0).type)
            yield pa.RecordBatch.from_arrays([queries_, pa.array(docs.ravel().tolist(), arrow.field(1).type), pa.array(scores.ravel())], schema=arrow)

    near = _grid(left, right, False).mapInArrow(best, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _top(scores: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of each row by score, equal ones by id, in order."""
    if scores.shape[1] > 4 * k:  # what cannot be among them is left out before the rows are put in order
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        near = scores >= edge[:, None]
        width = int(near.sum(axis=1).max())
        place = np.argsort(~near, axis=1, kind="stable")[:, :width]
        low = np.where(np.take_along_axis(near, place, 1), np.take_along_axis(scores, place, 1), -np.inf)
        scores, docs = low, np.take_along_axis(docs, place, 1)
    order = np.lexsort((docs, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(docs, order, 1)


def rerank_results(df: DataFrame, *, style: str = "jina", return_text: bool = False) -> DataFrame:
    """``(query_id, index, result)`` rows in input order, each a JSON object, plus tokens per query.

    ``df(query_id, index, score, n_tokens[, text])``.
    """
    score = "relevance_score" if style == "jina" else "score"
    fields = [F.col("index"), F.col("score").alias(score)]
    if return_text:
        fields.append(F.struct(F.col("text")).alias("document") if style == "jina" else F.col("text"))
    return df.select("query_id", "index", F.to_json(F.struct(*fields)).alias("result"), "n_tokens")


def rerank_usage(df: DataFrame) -> DataFrame:
    return df.groupBy("query_id").agg(F.sum("n_tokens").alias("prompt_tokens"), F.sum("n_tokens").alias("total_tokens"))


def class_scores(df: DataFrame, labels: DataFrame, *, key: str = "doc_id", scores: str = "scores") -> DataFrame:
    """``(key, label, score)``; a blank label name shows its index.  ``labels(idx, name)``."""
    rows = df.select(key, F.posexplode(scores).alias("idx", "score"))
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("idx").cast("string"))
    return rows.join(labels, "idx", "left").select(key, "idx", name.alias("label"), "score")


# ------------------------------------------------------------------ embedding output


@F.pandas_udf(T.BinaryType())
def float32_bytes(vecs: pd.Series) -> pd.Series:
    """Little-endian float32 bytes of each vector."""
    return vecs.map(lambda v: np.asarray(v, dtype="<f4").tobytes())


def embedding_objects(df: DataFrame, *, key: str, vec: str, base64: bool = False, bare: bool = False) -> DataFrame:
    """One JSON line per vector: list-object items, or bare arrays."""
    body = F.base64(float32_bytes(vec)) if base64 else F.col(vec)
    if bare:
        return df.select(key, F.to_json(body).alias("value"))
    fields = [F.col(key).alias("index"), body.alias("embedding"), F.lit("embedding").alias("object")]
    if base64:
        fields.append(F.lit("base64").alias("encoding_format"))
    return df.select(key, F.to_json(F.struct(*fields)).alias("value"))
