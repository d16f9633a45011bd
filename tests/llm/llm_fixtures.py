import duckdb
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside or return, as further columns of the input.
CLASHES = ["words", "template", "line", "host", "key", "spans", "fp", "root", "bucket", "rank", "shard", "slot", "n_words", "kept", "place", "hash", "size", "at"]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text, source) rows; with ``clash`` it has further columns."""

    def build(rows, clash=False):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"x{k}") for k, c in enumerate(CLASHES)})
        return df

    return build


@pytest.fixture(scope="session")
def edge_rows():
    words = " ".join(f"word{k % 977}" for k in range(60_000))
    plain = " ".join(f"w{k}" for k in range(80))
    return [(1, None, "a"), (2, "", "a"), (None, plain, None), (3, plain, "a"), (3, plain, "a"), (4, words, "b"), (5, "\n \t", None), (6, "x" * 100_000, "b"), (7, "é̂ 中文 \x00 \x1c 😀", "b")]


@pytest.fixture()
def duck():
    """DuckDB over pandas tables or a folder."""

    def connect(folder=None, **tables):
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            if folder and t not in tables:
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        for name, rows in tables.items():
            con.register(f"{name}_rows", rows)
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
        return con

    return connect
