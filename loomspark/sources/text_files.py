"""Text, JSON and CSV sources, and the sinks that mirror them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions.text import split_keep_empty
from loomspark.operators.benchmarks import FIELDS
from loomspark.plans.bounds import checked, fits
from loomspark.plans.prefix import running_sums

INSTRUCTION = "instruction string, input string, output string"
CORRUPT = "_corrupt_record"
# Blocks of text files whose places are sent to all tasks.
BLOCKS_SENT = 100_000
# Lines of quiz files that a task gets, about.
TASK_LINES = 500_000


def _read(spark: SparkSession, path, schema: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).option("multiLine", fmt == "json").json(path)


def read_instructions(spark: SparkSession, path, fmt: str = "json") -> DataFrame:
    """Instruction rows from a JSON array, JSON lines (``jsonl``) or Parquet."""
    return _read(spark, path, INSTRUCTION, fmt)


def read_texts(spark: SparkSession, path, fmt: str = "json") -> DataFrame:
    """Plain ``{text}`` rows; ``text`` reads one row per line."""
    if fmt == "text":
        return spark.read.text(path).withColumnRenamed("value", "text")
    return _read(spark, path, "text string", fmt)


def read_sharegpt(spark: SparkSession, path, fmt: str = "json") -> DataFrame:
    """Shared chats ``(id, turn, from, value)`` of JSON arrays or JSON lines."""
    rows = _read(spark, path, "id string, conversations array<struct<from:string,value:string>>", fmt)
    return rows.select("id", F.posexplode("conversations").alias("turn", "m")).select("id", "turn", "m.from", "m.value")


def split_records(df: DataFrame, col: str, sep: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, record_no, record)``: pieces between separators; what follows the last one is always a record."""
    return df.select(*keep, F.posexplode(split_keep_empty(F.col(col), sep)).alias("record_no", "record"))


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``(file, line_no, line)`` with lines counted from 0 in each file.

    A large file is read in blocks by many tasks, each of them from its first line to its last, so the ids of its lines follow one
    another; a line's number is its id, moved by where its block's ids begin and by the counts of the blocks in front.  Lines
    are not sorted and, up to ``BLOCKS_SENT`` blocks, not shuffled.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("blk"), F.monotonically_increasing_id().alias("mid"), F.col("value").alias("line")
    )
    counts = raw.groupBy("file", "blk").agg(F.count("*").alias("c"), F.min("mid").alias("first"))
    before = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    shift = counts.select("file", "blk", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    shift = F.broadcast(shift) if fits(raw.select("file", "blk").distinct(), BLOCKS_SENT) else shift
    return raw.join(shift, ["file", "blk"]).select("file", (F.col("mid") + F.col("shift")).cast("long").alias("line_no"), "line")


def read_quiz6(spark: SparkSession, path) -> DataFrame:
    """``(file, task, context, gold, endings)``: six lines a task; another number of lines is an error."""
    lines = numbered_lines(spark, path)
    counts = lines.groupBy("file").agg(F.count("*").alias("n"))
    seen = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") % 6 != 0).alias("bad")).first()
    if seen.bad:
        raise ValueError("the number of lines is not a multiple of 6")
    rows = lines.withColumn("task", F.floor(F.col("line_no") / 6)).withColumn("k", (F.col("line_no") % 6).cast("int"))
    # Text in aggregates is sorted, so lines are dealt out first: a task sorts its own, not a whole block.
    rows = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-(seen.n or 0) // TASK_LINES)), "file", "task")
    wide = rows.groupBy("file", "task").pivot("k", list(range(6))).agg(F.first("line"))
    return wide.select("file", "task", F.col("0").alias("context"), F.col("1").cast("int").alias("gold"), F.array("2", "3", "4", "5").alias("endings"))


def parse_blanks(df: DataFrame, line: str = "value") -> DataFrame:
    """Fill-in tasks ``(idx, first, second, choice1, choice2, answer)`` of CSV lines ``idx,sentence,choice1,choice2,answer``.

    Commas inside quotes do not split; only the sentence is unquoted; it is cut at its first blank mark.  Lines without
    four commas, a mark, or an answer of 1 or 2 are left out.
    """
    part = r'((?:[^,"]|"[^"]*")*)'
    pattern = rf"^{part},{part},{part},{part},(.*)$"
    pick = lambda i: F.regexp_extract(line, pattern, i)
    raw = pick(2)
    sentence = F.when(F.startswith(raw, F.lit('"')), F.substr(raw, F.lit(2), F.greatest(F.length(raw) - 2, F.lit(0)))).otherwise(raw)
    answer = F.regexp_extract(pick(5), r"^\s*\+?(\d+)", 1)
    rows = df.filter(F.col(line).rlike(pattern)).select(
        pick(1).alias("idx"), sentence.alias("s"), pick(3).alias("choice1"), pick(4).alias("choice2"), F.when(answer.isin("1", "2"), answer.cast("int")).alias("answer")
    )
    at = F.locate("_", F.col("s"))
    ok = rows.filter((at > 0) & F.col("answer").isNotNull())
    return ok.select("idx", F.substr("s", F.lit(1), at - 1).alias("first"), F.substr(F.col("s"), at + 1).alias("second"), "choice1", "choice2", "answer")


def read_blank_csv(spark: SparkSession, path) -> DataFrame:
    return parse_blanks(spark.read.text(path))


# ------------------------------------------------------------------ benchmark rows

# Rows of a gzipped file.
FILE_ROWS = 100_000
BENCH_SCHEMA = ", ".join(f"{n} {k}" for n, k in FIELDS)


def read_bench(spark: SparkSession, path, fmt: str = "jsonl") -> DataFrame:
    """Benchmark rows from JSON arrays, JSON lines or CSV; unknown columns are dropped, missing ones are an error."""
    if fmt == "csv":
        have = spark.read.option("header", True).csv(path).columns  # the header only
        _missing(have)
        rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        return rows.select(*[F.col(n).cast(k).alias(n) for n, k in FIELDS])
    reader = spark.read.option("multiLine", fmt == "json")
    raw = reader.schema("__row variant").option("singleVariantColumn", "__row").json(path)
    if fmt == "json":
        is_array = F.schema_of_variant("__row").startswith("ARRAY")
        items = F.when(is_array, F.try_variant_get("__row", "$", "array<variant>")).otherwise(F.array("__row"))
        raw = raw.select(F.explode(items).alias("__row"))
    keys = F.map_keys(F.try_variant_get("__row", "$", "map<string,variant>"))
    lacking = F.size(F.array_except(F.array(*[F.lit(n) for n, _ in FIELDS]), keys)) > 0
    raw = checked(raw, F.coalesce(lacking, F.lit(True)), "a benchmark row lacks a column")
    return raw.select(*[F.try_variant_get("__row", f"$.{n}", k).alias(n) for n, k in FIELDS])


def _missing(have: Sequence[str]) -> None:
    lacking = [n for n, _ in FIELDS if n not in have]
    if lacking:
        raise ValueError(f"benchmark rows lack {', '.join(lacking)}")


def write_bench(df: DataFrame, path: str, fmt: str = "jsonl") -> None:
    """Benchmark rows as gzipped CSV with a header, JSON lines, or files that each hold one JSON array.

    Every row repeats the names or the same few values, so the files shrink to a small part.  A gzipped file
    is read by one task, so a file holds ``FILE_ROWS`` rows at most (an array: those of one task).
    """
    rows = df.select(*[n for n, _ in FIELDS])
    if fmt == "csv":
        rows.write.option("header", True).option("quoteAll", True).option("maxRecordsPerFile", FILE_ROWS).csv(path, compression="gzip")
    elif fmt == "jsonl":
        rows.write.option("ignoreNullFields", False).option("maxRecordsPerFile", FILE_ROWS).json(path, compression="gzip")
    elif fmt == "json":
        items = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
        items.mapInPandas(_as_array, "value string").write.text(path, compression="gzip")  # one file, and one array, per task
    else:
        raise ValueError(f"unknown format {fmt}")


def _as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Put the brackets and commas of one JSON array around the rows a task streams through."""
    opened = False
    for pdf in batches:
        if len(pdf):
            out = "," + pdf["value"]
            if not opened:
                out.iloc[0] = "[" + out.iloc[0][1:]
                opened = True
            yield pd.DataFrame({"value": out})
    if opened:
        yield pd.DataFrame({"value": ["]"]})


def markdown_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a markdown table, and SQL inserts, are renderings of the same columns."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def sql_inserts(df: DataFrame, table: str = "test") -> DataFrame:
    names = [n for n, _ in FIELDS]
    values = [F.concat(F.lit("'"), F.replace(F.coalesce(F.col(n).cast("string"), F.lit("")), F.lit("'"), F.lit("''")), F.lit("'")) for n in names]
    head = f"INSERT INTO {table} ({', '.join(names)}) VALUES ("
    return df.select(F.concat(F.lit(head), F.concat_ws(", ", *values), F.lit(");")).alias("line"))


# ------------------------------------------------------------------ lists, logs, transcripts


def parse_checksums(df: DataFrame, line: str = "value") -> DataFrame:
    """``(hash, filename)`` of lines with two blanks between."""
    rows = df.filter(F.col(line).rlike(r"^\S+  .+$"))
    return rows.select(F.regexp_extract(line, r"^(\S+)  (.+)$", 1).alias("hash"), F.regexp_extract(line, r"^(\S+)  (.+)$", 2).alias("filename"))


def read_checksums(spark: SparkSession, path) -> DataFrame:
    return parse_checksums(spark.read.text(path))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """``(line, kind, hash, file, tensor, name)`` of ``kind hash file[:tensor]`` lines."""
    rows = numbered_lines(spark, path)
    pattern = r"^\s*(\S+)\s+(\S+)\s+(\S+)\s*$"
    pick = lambda i: F.regexp_extract("line", pattern, i)
    name = pick(3)
    tensor = F.when(F.contains(name, F.lit(":")), F.regexp_extract(name, r"^[^:]*:(.*)$", 1))
    return rows.filter(F.col("line").rlike(pattern)).select(
        F.col("line_no").alias("line"), pick(1).alias("kind"), pick(2).alias("hash"), F.regexp_extract(name, r"^([^:]*)", 1).alias("file"), tensor.alias("tensor"), name.alias("name")
    )


TOOL_BENCH = (
    "model string, server_name string, model_id string, test string, temp double, top_p double, top_k long, ctk string, ctv string, seed long, "
    "success_ratio double, avg_time double, median_time double, success_count long, success_times array<double>, failure_count long, "
    "failure_times array<double>, failures array<string>"
)
TOOL_BENCH_NEEDS = ("model", "server_name", "test", "success_ratio", "success_count", "failure_count")


def read_tool_bench(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(records, dropped lines) of tool-test logs: blank lines are skipped, malformed or incomplete ones dropped with a reason."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", f"{TOOL_BENCH}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    lacking = F.lit(False)
    for c in TOOL_BENCH_NEEDS:
        lacking = lacking | F.col(f"r.{c}").isNull()
    reason = F.when(F.col(f"r.{CORRUPT}").isNotNull(), "malformed").when(lacking, "incomplete")
    parsed = parsed.withColumn("reason", reason)
    return parsed.filter("reason IS NULL").select("r.*").drop(CORRUPT), parsed.filter("reason IS NOT NULL").select("value", "reason")


def read_transcripts(spark: SparkSession, path, sheet: DataFrame, *, model_pattern: str = r"([^/]+?)(?:\.txt)?$") -> DataFrame:
    """``(model, question_no, answer, question, correct)``: records between ``------`` lines, joined to ``sheet`` by ordinal.

    Row 0 of the sheet is its header, so record 0 meets row 1.  The text behind the last separator is no record.  The model is
    what ``model_pattern`` finds in the file's path.
    """
    lines = numbered_lines(spark, path)
    mark = F.trim("line") == "------"
    rows = running_sums(lines.withColumn("mark", mark), ["file"], "line_no", {"rec": F.col("mark").cast("long")}, inclusive=False)
    ends = rows.filter("mark").select("file", "rec")
    bodies = rows.filter("NOT mark").groupBy("file", "rec").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    text = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    answers = ends.join(bodies, ["file", "rec"], "left").select("file", (F.col("rec") + 1).alias("question_no"), F.coalesce(text, F.lit("")).alias("answer"))
    model = F.regexp_extract("file", model_pattern, 1)
    return answers.join(sheet, "question_no", "left").select(model.alias("model"), "question_no", "answer", *[c for c in sheet.columns if c != "question_no"])


def check_weight_map(index: DataFrame, parts: DataFrame) -> DataFrame:
    """Tensors on one side only: ``(tensor, problem, file)``, problem being missing or extra; empty means intact.

    ``index(tensor, file)`` lists what should be there, ``parts(tensor)`` what is.
    """
    want = index.select("tensor", F.col("file").alias("want"))
    got = parts.select("tensor").distinct().withColumn("got", F.lit(True))
    both = want.join(got, "tensor", "full_outer")
    problem = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "extra")
    return both.select("tensor", problem.alias("problem"), F.col("want").alias("file")).filter("problem IS NOT NULL")


def missing_files(problems: DataFrame) -> DataFrame:
    return problems.filter("problem = 'missing' AND file IS NOT NULL").select("file").distinct()


def read_prompt_pairs(spark: SparkSession, positive, negative, *, group_pattern: str = "()") -> DataFrame:
    """``(grp, pair, positive, negative)`` from files of lines; blank lines are skipped, and both sides must hold as many.

    Files belong together when ``group_pattern`` finds the same text in their paths; by default there is one on each side.
    """

    def lines(path) -> DataFrame:
        rows = numbered_lines(spark, path).filter(F.trim("line") != "").withColumn("grp", F.regexp_extract("file", group_pattern, 1))
        return running_sums(rows, ["grp"], "line_no", {"pair": F.lit(1).cast("long")}, inclusive=False).select("grp", "pair", "line")

    both = lines(positive).withColumnRenamed("line", "positive").join(lines(negative).withColumnRenamed("line", "negative"), ["grp", "pair"], "full_outer")
    if both.isEmpty():
        raise ValueError("no prompts")
    return checked(both, F.col("positive").isNull() | F.col("negative").isNull(), "the files hold different numbers of prompts")


# ------------------------------------------------------------------ web pages


class _Page(HTMLParser):
    """Visible text of a page; block elements end lines."""

    BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table title tr ul".split())
    HIDDEN = frozenset(("script", "style", "head", "template"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden = max(0, self.hidden - (tag in self.HIDDEN))
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data.replace("\n", " "))


@F.pandas_udf(T.StringType())
def html_text(pages: pd.Series) -> pd.Series:
    def one(html: str) -> str:
        page = _Page()
        page.feed(html or "")
        page.close()
        return "".join(page.out)

    return pages.map(one)


def wrap(line: Column, width: int = 80) -> Column:
    """Break a line at blanks so that no part is longer than ``width``, where words allow."""
    return F.regexp_replace(F.regexp_replace(line, rf"(.{{1,{width}}})(?:\s+|$)", "$1\n"), r"\n$", "")


def pages_to_text(df: DataFrame, *, key: str = "page_id", html: str = "html", skip: int = 3, width: int = 80) -> DataFrame:
    """``(key, text)``: page text without its first lines and leading blanks, wrapped."""
    rows = df.select(key, html_text(html).alias("t"))
    lines = F.split("t", "\n", -1)
    body = F.transform(F.slice(lines, skip + 1, 1 << 30), lambda x: wrap(F.regexp_replace(x, r"^\s+", ""), width))
    return rows.select(key, F.array_join(body, "\n").alias("text"))
