"""User functions: formatting, scoring and embedding of whole tables with code the user brings."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators.windows import batches_of


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply ``fn`` to dicts of column lists, batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(fn({c: pdf[c].tolist() for c in pdf.columns}))

    return df.mapInPandas(run, schema)


def observe(df: DataFrame, ask: Callable[[DataFrame], Column], collect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``collect`` makes of the rows that ``ask`` wants to see; rows nobody asks for are never read further."""
    return collect(df.filter(F.coalesce(ask(df), F.lit(False))))


def score_with(df: DataFrame, make: Callable[[], Callable[[list[str]], list]], out_type: str, *, key: str, text: str, name: str = "reply") -> DataFrame:
    """``(key, name)``: the user's model over every row; ``make`` builds it once per task."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], name: model(pdf[text].tolist())})

    return df.select(key, text).mapInPandas(run, f"{key} {key_type}, {name} {out_type}")


def embed_with(df: DataFrame, make: Callable[[], Callable[[list], np.ndarray]], budget: int, *, key: str, tokens: str = "tokens") -> DataFrame:
    """``(key, vec)``: the user's embedder over batches of at most ``budget`` tokens."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches_of(batches, "__n", budget):
            yield pd.DataFrame({key: pdf[key].to_numpy(), "vec": list(model(pdf[tokens].tolist()))})

    return df.select(key, tokens, F.size(tokens).alias("__n")).mapInPandas(run, f"{key} {key_type}, vec array<double>")


def toy_generator(max_new: int = 1200) -> Callable[[list[str]], list[str]]:
    """A stand-in model: repeats the words of its prompt backwards."""
    return lambda prompts: [" ".join(p.split()[::-1][:max_new]) for p in prompts]


def toy_embedder(width: int = 16) -> Callable[[list], np.ndarray]:
    """A stand-in embedder: counts of hashed tokens, at unit length."""

    def embed(rows: list) -> np.ndarray:
        out = np.zeros((len(rows), width))
        for i, toks in enumerate(rows):
            for t in toks:
                out[i, hashlib.md5(str(t).encode()).digest()[0] % width] += 1.0
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=np.zeros_like(out), where=size > 0)

    return embed


@F.udtf(returnType="window_no int, start int, piece string")
class TextWindows:
    """Overlapping windows of words: ``LATERAL text_windows(text, size, stride)``."""

    def eval(self, text: str, size: int, stride: int):
        words = (text or "").split()
        for no, start in enumerate(range(0, max(len(words) - size, 0) + 1, stride)):
            yield no, start, " ".join(words[start : start + size])


def register_table_functions(spark) -> None:
    spark.udtf.register("text_windows", TextWindows)
