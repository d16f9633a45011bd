"""Structured Streaming jobs.

Each job is a plan on a streaming DataFrame; :func:`run_to_table` runs one over what is available and returns the written table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from loomspark.operators.benchmarks import service_metrics
from loomspark.operators.ngrams import ESC, NGRAM_MAX, SEP, read_token, written_token
from loomspark.plans.scratch import fresh_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IDLE_MS = 3_600_000
LATE = "10 minutes"


def table_stream(spark: SparkSession, folder: str, name: str, *, files_per_batch: int = 1) -> DataFrame:
    """One table of a folder of Parquet files as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def folder_stream(spark: SparkSession, path: str, schema, *, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_table(stream: DataFrame, what: str, path: str | None = None, progress: list | None = None) -> DataFrame:
    """Run an append-mode stream over the available data; its rows land in a Parquet table of the shared folder.

    Run again with the same ``path`` it goes on from its checkpoint, and the table grows.  ``progress`` gets what each
    micro-batch reports.
    """
    spark = stream.sparkSession
    path = path or fresh_folder(spark, what)
    # Each batch opens a state store and a Python worker for each partition, whatever it holds: as many as there are cores.
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(usual), spark.sparkContext.defaultParallelism)))
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{path}/rows")
            .option("checkpointLocation", f"{path}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    if progress is not None:
        progress.extend(query.recentProgress)
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def run_snapshots(stream: DataFrame, what: str, close: Callable[[DataFrame], DataFrame] | None = None, *, every: int = 1) -> DataFrame:
    """Run a complete-mode aggregation; every so many batches ``close`` of the totals is written, with its batch number.

    A batch that is run again overwrites its own snapshot.
    """
    spark = stream.sparkSession
    path = fresh_folder(spark, what)

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        if batch_id % every == 0:
            out = close(batch) if close else batch
            out.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        else:
            batch.write.format("noop").mode("overwrite").save()  # state is committed only for batches that are read

    query = (
        stream.writeStream.foreachBatch(snapshot).outputMode("complete").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows/*")


def latest(snapshots: DataFrame) -> DataFrame:
    """Rows of the last snapshot."""
    last = snapshots.agg(F.max("batch").alias("batch"))
    return snapshots.join(F.broadcast(last), "batch").drop("batch")  # one row


# ------------------------------------------------------------------ state by key


def _timed(stream: DataFrame, ts: str | None, late: str) -> DataFrame:
    """The stream with its event time in ``event_time``: a column of its own, or else the time of the batch that brings a row."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # the store that has lists, maps and timers
    time = F.current_timestamp() if ts is None else F.col(ts)
    return stream.withColumn("event_time", time.cast("timestamp")).withWatermark("event_time", late)


#: Groups that keys are dealt to.  A call of Python and its trips to the store are paid for each group, not each key; many more than
#: there are tasks, few enough that a group has many keys where there are millions.  State that is kept was dealt by it.
GROUPS = 512
#: A group's state is read whole unless it has so many times the keys of a batch.
MANY = 8


def _grouped(stream: DataFrame, key: str):
    """Rows with ``at``, their time in milliseconds, dealt to groups by ``key``."""
    rows = stream.withColumn("at", F.unix_millis("event_time")).withColumn("key_group", F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int"))
    return rows.groupBy("key_group")


class _Timed(StatefulProcessor):
    """State of the keys of a group; a key's goes when the watermark has passed its last row by ``idle_ms``.

    The map ``main`` has a row for each key, which ends with the time when it goes.  A group has one timer, set for the first of these times or sooner.
    """

    main, columns = "", ()

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "due long, n long")

    def read(self, state, keys) -> dict:
        """What ``state`` has for these keys, and for others too where that is cheaper."""
        held = self.timer.get()
        if held is None:
            return {}
        if len(keys) * MANY < held[1]:
            return {k: tuple(state.getValue((k,))) for k in keys if state.containsKey((k,))}
        return {k[0]: tuple(v) for k, v in state.iterator()} if state.exists() else {}

    def keep_until(self, due: int, more: int) -> None:
        """Move the timer in front of ``due``, never behind; the group has ``more`` keys than before."""
        held = self.timer.get()
        if held is None or due < held[0]:
            if held is not None:
                self.handle.deleteTimer(held[0])
            self.handle.registerTimer(due)
        if held is None or due < held[0] or more:
            self.timer.update((due if held is None else min(due, held[0]), more + (0 if held is None else held[1])))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Keys whose time has come go; the timer moves to the first of the others."""
        now = timerValues.getCurrentWatermarkInMs()
        main = getattr(self, self.main)
        rows = {k[0]: tuple(v) for k, v in main.iterator()} if main.exists() else {}
        out = self.close_keys({k: v for k, v in rows.items() if v[-1] < now})
        left = [v[-1] for v in rows.values() if v[-1] >= now]
        if left:
            self.handle.registerTimer(min(left))
            self.timer.update((min(left), len(left)))
        else:
            self.timer.clear()
        yield pd.DataFrame(out, columns=self.columns)

    def close_keys(self, rows: dict) -> list:
        """Clear the state of these keys; what is told of them at last."""
        raise NotImplementedError

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ n-grams


def _joined(tokens) -> Column:
    """An array of tokens as one string."""
    plain = F.array_join(tokens, "", "")
    odd = F.contains(plain, F.lit(SEP)) | F.contains(plain, F.lit(ESC))
    return F.when(odd, F.array_join(F.transform(tokens, written_token), SEP)).otherwise(F.array_join(tokens, SEP, ESC + "n"))


def _split(text) -> Column:
    pieces = F.split(text, SEP, -1)
    return F.when(F.contains(text, F.lit(ESC)), F.transform(pieces, lambda t: read_token(t, "string"))).otherwise(pieces)


class _Chunks(_Timed):
    """Hands on each chunk behind the last tokens before it."""

    main, columns = "expect", ("run", "known", "gap")

    def init(self, handle) -> None:
        super().init(handle)
        self.tail = handle.getMapState("tail", "doc string", "tokens string")
        self.expect = handle.getMapState("expect", "doc string", "seq long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        docs, times = {}, {}
        for pdf in rows:
            for doc, *chunk, at in zip(pdf["doc"], pdf["seq"], pdf["run"], pdf["n"], pdf["at"]):
                docs.setdefault(doc, []).append(chunk)
                times[doc] = max(at, times.get(doc, at))
        expects = self.read(self.expect, docs)
        tails = self.read(self.tail, docs)
        out, first, more = [], None, 0
        for doc, chunks in docs.items():
            was, had = expects.get(doc), tails.get(doc)
            expect, tail, gaps = was[0] if was else 0, had[0].split(SEP) if had else [], 0
            chunks.sort(key=lambda c: c[0])
            if len({c[0] for c in chunks}) < len(chunks):
                chunks.sort(key=lambda c: (c[0], c[1].split(SEP) if c[2] else []))
            for seq, run, n in chunks:
                gaps += seq != expect
                if seq < expect:
                    continue
                if seq > expect:
                    tail = []
                expect = int(seq) + 1
                if n:
                    out.append((SEP.join([*tail, run]), len(tail), 0))
                    tail = [*tail, *run.rsplit(SEP, NGRAM_MAX)[-min(n, NGRAM_MAX) :]][-NGRAM_MAX:]
            if gaps:
                out.append((None, 0, gaps))
            due = max(int(times[doc]) + self.idle_ms, was[1] if was else 0)
            if (expect, due) != was:
                self.expect.updateValue((doc,), (expect, due))
            if tail and (not had or SEP.join(tail) != had[0]):
                self.tail.updateValue((doc,), (SEP.join(tail),))
            elif not tail and had:
                self.tail.removeKey((doc,))
            first, more = min(due, first or due), more + (was is None)
        self.keep_until(first, more)
        yield pd.DataFrame(out, columns=self.columns)

    def close_keys(self, rows: dict) -> list:
        for doc in rows:
            self.expect.removeKey((doc,))
            if self.tail.containsKey((doc,)):
                self.tail.removeKey((doc,))
        return []


def incremental_ngrams(stream: DataFrame, n_min: int = 1, n_max: int = NGRAM_MAX, *, ts: str | None = None, late: str = LATE, idle_ms: int = IDLE_MS) -> DataFrame:
    """Count increments ``(n, ngram, token, cnt, gap)`` of append-only chunks ``(doc_id, seq, tokens array<string>)``.

    State is the last four tokens and the next chunk number of each document; it goes when the watermark of ``ts`` (else of
    the time of arrival) is ``idle_ms`` behind the document's last chunk.  Where chunks are missing a gap row without
    n-gram is told and counting begins anew behind it, so no n-gram reaches over the gap; a chunk that comes after its turn
    is told as a gap too and is not counted, and one behind the watermark is dropped.

    Python puts the tokens before it in front of each chunk, as strings; the n-grams are cut from them in the row, a row for each place.
    """
    doc = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("doc")
    size = F.greatest(F.size("tokens"), F.lit(0)).alias("n")
    rows = _timed(stream, ts, late).select(doc, "seq", F.coalesce(_joined(F.col("tokens")), F.lit("")).alias("run"), size, "event_time")
    runs = _grouped(rows, "doc").transformWithStateInPandas(_Chunks(idle_ms), "run string, known int, gap long", "Append", "EventTime")
    runs = runs.select(_split(F.col("run")).alias("a"), "known", "gap")
    # The tokens from the first new one on, each beside those before it: shifted copies of one array.
    new = F.size("a") - F.col("known")
    before = [F.concat(F.array_repeat(F.lit(None).cast("string"), k), "a") for k in range(n_max, 0, -1)]
    slots = [F.slice(c, F.col("known") + 1, new).alias(f"p{k}") for c, k in zip(before, range(n_max, 0, -1))]
    places = F.sequence(F.col("known"), F.size("a") - 1).alias("i")
    cut = runs.select("gap", F.posexplode_outer(F.when(F.col("gap") == 0, F.arrays_zip(places, *slots, F.slice("a", F.col("known") + 1, new).alias("token")))).alias("at", "z"))
    gram = lambda n: F.array(*[F.col(f"z.p{k}") for k in range(n, 0, -1)])
    each = F.array(*[F.when(F.col("z.i") >= n, F.struct(F.lit(n).alias("n"), gram(n).alias("ngram"))) for n in range(n_min, n_max + 1)])
    gap = F.array(F.struct(F.lit(0).alias("n"), F.slice(F.array(F.lit("")), 1, 0).alias("ngram")))
    out = cut.select("gap", "z.token", F.explode(F.when(F.col("gap") > 0, gap).otherwise(each)).alias("g")).filter("g IS NOT NULL")
    return out.select("g.n", "g.ngram", "token", F.when(F.col("gap") > 0, 0).otherwise(1).cast("long").alias("cnt"), "gap")


# ------------------------------------------------------------------ replies


def held_from(text: str, stops: Sequence[str]) -> int:
    """Where the end of ``text`` begins that may be the start of a stop word."""
    cut = len(text)
    for stop in stops:
        for n in range(min(len(stop) - 1, len(text)), 0, -1):
            if text.endswith(stop[:n]):
                cut = min(cut, len(text) - n)
                break
    return cut


class _ReplyAssembler(_Timed):
    """``open`` has the next number, the text held back and the deltas ahead of a reply; of a finished one its time only."""

    main, columns = "open", ("reply_id", "seq", "text", "done")

    def __init__(self, stops: Sequence[str], idle_ms: int):
        super().__init__(idle_ms)
        self.stops = list(stops)

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getMapState("open", "reply_id long", "expect long, held string, ahead long, due long")
        # A row for what came ahead in one batch, by the first of its numbers.
        self.waiting = handle.getMapState("waiting", "reply_id long, seq long", "seqs array<long>, deltas array<string>, lasts array<boolean>")

    def ahead(self, replies) -> dict:
        """Waiting deltas of these replies, by reply, row and number."""
        out: dict[int, dict] = {r: {} for r in replies}
        if out and self.waiting.exists():
            for (reply, first), (seqs, deltas, lasts) in self.waiting.iterator():
                if reply in out:
                    out[reply][first] = {s: (d, e) for s, d, e in zip(seqs, deltas, lasts)}
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        replies, times = {}, {}
        for pdf in rows:
            for r, s, d, e, at in zip(pdf["reply_id"], pdf["seq"], pdf["delta"], pdf["last"], pdf["at"]):
                replies.setdefault(r, {}).setdefault(int(s), (d, bool(e)))
                times[r] = max(at, times.get(r, at))
        held_of = self.read(self.open, replies)
        waiting = self.ahead([r for r in replies if r in held_of and held_of[r][2]])
        out, first, more = [], None, 0
        for r, deltas in replies.items():
            was = held_of.get(r)
            expect, held, _, due = was or (0, "", 0, 0)
            due = max(int(times[r]) + self.idle_ms, due)
            first, more = min(due, first or due), more + (was is None)
            kept = waiting.get(r, {})
            ahead = {s: v for row in kept.values() for s, v in row.items()}
            done = expect is None
            deltas |= ahead
            while not done and expect in deltas:
                delta, is_last = deltas[expect]
                text = held + (delta or "")
                hits = [i for i in (text.find(s) for s in self.stops) if i >= 0]
                if hits:
                    part, held, done = text[: min(hits)], "", True
                elif is_last:
                    part, held, done = text, "", True
                else:
                    at = held_from(text, self.stops)
                    part, held = text[:at], text[at:]
                if part or done:
                    out.append((r, expect, part, done))
                expect += 1
            later = {} if done else {s: v for s, v in deltas.items() if s >= expect}
            for seq, row in kept.items():
                if not any(s in later for s in row):
                    self.waiting.removeKey((r, seq))
            fresh = {s: v for s, v in later.items() if s not in ahead}
            if fresh:
                self.waiting.updateValue((r, min(fresh)), (list(fresh), [d for d, _ in fresh.values()], [e for _, e in fresh.values()]))
            now = (None, None, 0, due) if done else (expect, held, len(later), due)
            if now != was:
                self.open.updateValue((r,), now)
        self.keep_until(first, more)
        yield pd.DataFrame(out, columns=self.columns)

    def close_keys(self, rows: dict) -> list:
        for r, kept in self.ahead([r for r, v in rows.items() if v[2]]).items():
            for seq in kept:
                self.waiting.removeKey((r, seq))
        for r in rows:
            self.open.removeKey((r,))
        return [(r, v[0], v[1], True) for r, v in rows.items() if v[0] is not None]


def assemble_replies(stream: DataFrame, stops: Sequence[str], *, ts: str | None = None, late: str = LATE, idle_ms: int = IDLE_MS) -> DataFrame:
    """Released text ``(reply_id, seq, text, done)`` of deltas ``(reply_id, seq, delta, last)``, numbered from 0.

    Text that may be the start of a stop word is held back until it is clear; a stop word ends the reply and is not released.
    A delta that comes ahead of its turn waits in the state, in whatever batch the ones before it come; one that was
    there already is passed over, and one without a reply id belongs to no reply.  A finished reply leaves its time and nothing else.  When the watermark of ``ts`` (else of the
    time of arrival) is ``idle_ms`` behind a reply's last delta, that goes too, and a reply that is still open is closed: what was
    held back is released, what waits behind a missing delta is given up.
    """
    rows = _timed(stream, ts, late).select("reply_id", "seq", "delta", "last", "event_time").filter("reply_id IS NOT NULL")
    return _grouped(rows, "reply_id").transformWithStateInPandas(
        _ReplyAssembler(stops, idle_ms), "reply_id long, seq long, text string, done boolean", "Append", "EventTime"
    )


# ------------------------------------------------------------------ service


def service_buckets(stream: DataFrame, step: str, late: str, *, ts: str = "ts") -> DataFrame:
    """Counters and gauges per closed time bucket; later rows are dropped."""
    bucket = F.window(ts, step).alias("bucket")
    return service_metrics(stream.withWatermark(ts, late), bucket)


def service_totals(stream: DataFrame) -> DataFrame:
    return service_metrics(stream)


def metric_stream(stream: DataFrame, step: str, late: str, *, ts: str = "ts", value: str = "value", keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Mean per closed step; ``slide`` makes the windows overlap."""
    w = (F.window(ts, step, slide) if slide else F.window(ts, step)).alias("w")
    out = stream.withWatermark(ts, late).groupBy(*keys, w).agg(F.avg(value).alias("value"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "value")


def session_stream(stream: DataFrame, gap: str, late: str, *, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """Rows and span of closed sessions."""
    out = stream.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def truncation_alerts(stream: DataFrame, step: str, late: str, *, ts: str = "ts", limit: float = 0.8, since=None) -> DataFrame:
    """Closed buckets whose share of truncated replies reaches the limit, from one minute after ``since`` on."""
    rate = F.avg((F.col("finish") == "length").cast("double"))
    out = stream.withWatermark(ts, late).groupBy(F.window(ts, step).alias("w")).agg(rate.alias("rate"), F.count("*").alias("n"))
    out = out.filter(F.col("rate") >= limit)
    if since is not None:
        out = out.filter(F.col("w.start") >= F.lit(since) + F.expr("INTERVAL 1 MINUTE"))
    return out.select(F.col("w.start").alias("start"), "rate", "n")


def distinct_failures(stream: DataFrame, late: str, *, ts: str = "ts", keys: Sequence[str] = ("model", "test", "error")) -> DataFrame:
    """The first of equal failure texts within the watermark delay."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


# ------------------------------------------------------------------ running statistics


def running_importance(stream: DataFrame) -> DataFrame:
    """Sums of squares per tensor, expert and column; sums commute, so order does not matter."""
    return stream.groupBy("tensor", "expert", "col").agg(F.sum(F.col("x") * F.col("x")).alias("sum_sq"), F.count("*").alias("cnt"))


def running_loss(stream: DataFrame, *keys: str) -> DataFrame:
    """Loss sums and correct answers; the closed forms are taken per snapshot."""
    return stream.groupBy(*keys).agg(
        F.sum("nll").alias("s"), F.sum(F.col("nll") * F.col("nll")).alias("s2"), F.count("nll").alias("n"), F.sum(F.col("correct").cast("long")).alias("k")
    )


def close_loss(sums: DataFrame) -> DataFrame:
    """Perplexity with its error, and accuracy with its interval, of :func:`running_loss` sums."""
    from loomspark.operators.metrics import wilson

    mean = F.col("s") / F.col("n")
    var = F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))
    low, high = wilson("k", "n")
    keep = [c for c in sums.columns if c not in ("s", "s2", "n", "k")]
    return sums.select(
        *keep, "n", F.exp(mean).alias("ppl"), (F.exp(mean) * F.sqrt(var / F.nullif(F.col("n") - 1, F.lit(0)))).alias("err"), (F.col("k") / F.col("n")).alias("acc"), low.alias("low"), high.alias("high")
    )
