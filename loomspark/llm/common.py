"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loomspark.plans.scratch import written

#: Words of the contracts: runs of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

#: Rows a batch of texts holds on its way to a Python worker; long texts keep it from growing large.
BATCH_ROWS = 256
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound the text that is in a Python worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_rows(df: DataFrame, start: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """One row of ``schema`` for each row of ``df``; ``start()`` makes the row function once a task."""
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = start()
        for batch in batches:
            rows = [work(*r) for r in zip(*(c.to_pylist() for c in batch.columns))]
            columns = zip(*rows) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def row_key(*columns: Column) -> Column:
    """A key that rows share only if they agree in all ``columns``, nulls included (up to a 64-bit hash of the texts)."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]
    return F.concat_ws("\x01", *parts)


def span_text(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of each span, comma-joined; spans are structs of start, kind (a place in ``kinds``) and end."""
    name = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["start"], x["end"])), ",")


def span_digest(spans: Column, kinds: Sequence[str], base: Sequence[str]) -> list[Column]:
    """Counts of the ``base`` kinds (the first of ``kinds``), the hash of their spans, and all spans as text."""
    own = F.filter(spans, lambda x: x["kind"] < len(base))

    def count(k):
        return F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(base)]
    return [*counts, F.sha2(span_text(own, kinds), 256).alias("base_sha256"), span_text(spans, kinds).alias("spans")]


def ranked(df: DataFrame, order: Sequence[str], name: str, what: str, within: Sequence[str] = ()) -> DataFrame:
    """``df`` with the rank (long, from 0) of each row in ``order``, or in each ``within``, which ``order`` begins with.

    The rows are range-partitioned by ``order`` and written once, so that a rank is a place within a partition plus
    the rows before it.  One group of any size is spread over many partitions; only one total for each partition and
    group meets in one place.  Ties in the whole of ``order`` fall in any order, so give it a last column that tells rows apart.
    """
    from pyspark.sql import Window

    within = list(within)
    placed = written(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("__part", F.spark_partition_id()), what)
    totals = placed.groupBy(*within, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long"))).drop("__n")
    inside = Window.partitionBy("__part", *within).orderBy(*order)
    on = [F.col("l.__part") == F.col("r.__part"), *[F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in within]]
    local = placed.withColumn("__local", F.row_number().over(inside) - 1)
    joined = local.alias("l").join(totals.alias("r"), on)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("__local") + F.col("__before")).alias(name))


#: A key of more than one row in this many is hot; so there are fewer hot keys than this, whatever the table.
HOT_ONE_IN = 1000


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``left`` joined to its row of ``right``, in which ``keys`` are unique and not null; rows without one go.

    Keys that hold more than a thousandth of ``left`` are counted first; there are fewer than a thousand of them by
    definition, so their rows of ``right`` are broadcast.  No key of the rest can fill a task of the shuffle.
    ``left`` is read three times, so give a written table.
    """
    keys = list(keys)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = written(counts.filter(F.col("__n") * HOT_ONE_IN > left.count()).select(*keys), what)
    rare = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys)
    if hot.isEmpty():
        return rare
    return rare.unionByName(left.join(F.broadcast(right.join(F.broadcast(hot), keys, "left_semi")), keys))
