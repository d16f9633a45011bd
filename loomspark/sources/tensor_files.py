"""Tensor files as a Spark data source: metadata, tensor list and tensor bytes.

``spark.dataSource.register(TensorFiles)``, then ``spark.read.format("tensorfile").option("what", …).load(path)``.
The driver lists files and their sizes.  Tasks read the headers; the bytes of a tensor are read by the task whose range of the file
they begin in.  Small files share a task.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomspark.functions.blocks import BLOCK_SIZES
from loomspark.sources.ranges import RANGE_BYTES, Bytes, Cursor, locate

MAGIC = 0x46554747
VERSIONS = (2, 3)
ALIGNMENT = 32
# What opening a file and reading its header counts for, in bytes, when files are dealt out to tasks.
OPEN_BYTES = 1 << 20
# Value types by number: name and struct code.  Fixed values.
VALUE_TYPES = {
    0: ("UINT8", "B"), 1: ("INT8", "b"), 2: ("UINT16", "H"), 3: ("INT16", "h"), 4: ("UINT32", "I"), 5: ("INT32", "i"), 6: ("FLOAT32", "f"),
    7: ("BOOL", "?"), 8: ("STRING", ""), 9: ("ARRAY", ""), 10: ("UINT64", "Q"), 11: ("INT64", "q"), 12: ("FLOAT64", "d"),
}
# Tensor types by number: fixed values.
TENSOR_TYPES = {
    0: "F32", 1: "F16", 2: "Q4_0", 3: "Q4_1", 6: "Q5_0", 7: "Q5_1", 8: "Q8_0", 9: "Q8_1", 10: "Q2_K", 11: "Q3_K", 12: "Q4_K", 13: "Q5_K",
    14: "Q6_K", 15: "Q8_K", 16: "IQ2_XXS", 17: "IQ2_XS", 18: "IQ3_XXS", 19: "IQ1_S", 20: "IQ4_NL", 21: "IQ3_S", 22: "IQ2_S", 23: "IQ4_XS",
    24: "I8", 25: "I16", 26: "I32", 27: "I64", 28: "F64", 29: "IQ1_M", 30: "BF16", 34: "TQ1_0", 35: "TQ2_0",
}
SCHEMAS = {
    "kv": "file string, idx long, key string, type string, is_array boolean, items array<string>, byte_offset long",
    "tensors": "file string, idx long, tensor string, type string, shape array<long>, n_elements long, n_bytes long, byte_offset long",
    "data": "file string, idx long, tensor string, type string, part long, data binary",
}


class _Header:
    """Metadata and tensor list of one open file."""

    def __init__(self, data: Bytes):
        self.cur = Cursor(data)
        if self._one("I") != MAGIC:
            raise ValueError("not a tensor file")
        version = self._one("I")
        if version & 0xFFFF == 0:  # written with the other byte order
            self.cur.order, self.cur.at = ">", 4
            version = self._one("I")
        if version not in VERSIONS:
            raise ValueError(f"version {version} is not supported")
        n_tensors, n_kv = self._one("Q"), self._one("Q")
        self.warnings: list[str] = []
        self.kv = self._metadata(n_kv)
        self.tensors = self._tensors(n_tensors)

    def _one(self, code: str):
        return self.cur.ints(1, code)[0]

    def _text(self) -> str:
        return self.cur.text("Q")

    def _value(self, kind: int) -> tuple[str, list[str], bool]:
        if kind not in VALUE_TYPES:
            raise ValueError(f"unknown value type {kind}")
        name, code = VALUE_TYPES[kind]
        if name == "STRING":
            return name, [self._text()], False
        if name == "ARRAY":
            inner, n = self._one("I"), self._one("Q")
            parts = [self._value(inner) for _ in range(n)]
            leaf = parts[0][0] if parts else VALUE_TYPES.get(inner, ("",))[0]
            return leaf, [x for p in parts for x in p[1]], True
        return name, [str(self._one(code))], False

    def _metadata(self, n: int) -> list[tuple]:
        out, seen = [], set()
        for idx in range(n):
            at = self.cur.at
            key = self._text()
            name, items, is_array = self._value(self._one("I"))
            if key in seen:
                self.warnings.append(f"duplicate key {key} at {at}")
                key = f"{key}_{at}"
            seen.add(key)
            out.append((idx, key, name, is_array, items, at))
        return out

    def _tensors(self, n: int) -> list[tuple]:
        align = next((int(i[0]) for _, k, _, _, i, _ in self.kv if k == "general.alignment"), ALIGNMENT)
        found, names = [], set()
        for idx in range(n):
            name = self._text()
            if name in names:
                raise ValueError(f"two tensors are named {name}")
            names.add(name)
            dims = [self._one("Q") for _ in range(self._one("I"))]
            kind, offset = self._one("I"), self._one("Q")
            if kind not in TENSOR_TYPES:
                raise ValueError(f"unknown tensor type {kind}")
            found.append((idx, name, TENSOR_TYPES[kind], dims, offset))
        start = -(-self.cur.at // align) * align
        out = []
        for idx, name, kind, dims, offset in found:
            elements = 1
            for d in dims:
                elements *= d
            block, size = BLOCK_SIZES[kind]
            out.append((idx, name, kind, dims[::-1], elements, elements * size // block, start + offset))
        return out


@dataclass
class _Range:
    file: str
    start: int = 0
    stop: int = 0


@dataclass
class _Part(InputPartition):
    ranges: list[_Range]


def _listed(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of a file, or of what a pattern in the last part of a path stands for."""
    fs, inside = locate(path)
    folder, _, pattern = inside.rpartition("/")
    root = path[: len(path) - len(inside)] if path.endswith(inside) else ""
    found = fs.get_file_info(arrow_fs.FileSelector(folder or "/", allow_not_found=True))
    return sorted((root + f.path, f.size) for f in found if f.type == arrow_fs.FileType.File and fnmatch.fnmatchcase(f.base_name, pattern))


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.what = options.get("what", "tensors")
        self.files = _listed(options["path"])
        self.range = int(options.get("rangeBytes", str(RANGE_BYTES)))
        self.piece = int(options.get("pieceBytes", str(RANGE_BYTES)))
        if not self.files:
            raise ValueError(f"no files at {options['path']}")

    def partitions(self):
        """Ranges of files, as many to a task as make up ``rangeBytes``."""
        parts, held = [], 0
        for name, size in self.files:
            for at in range(0, max(size, 1), self.range) if self.what == "data" else (0,):
                cost = OPEN_BYTES + (min(self.range, size - at) if self.what == "data" else 0)
                if not parts or held + cost > self.range:
                    parts.append(_Part([]))
                    held = 0
                parts[-1].ranges.append(_Range(name, at, at + self.range))
                held += cost
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        for part in partition.ranges:
            with Bytes(part.file) as data:
                head = _Header(data)
                if self.what == "kv":
                    for row in head.kv:
                        yield (part.file, *row)
                elif self.what == "tensors":
                    for row in head.tensors:
                        yield (part.file, *row)
                else:
                    yield from self._pieces(part, data, head.tensors)

    def _pieces(self, partition: _Range, data: Bytes, tensors: list[tuple]) -> Iterator[tuple]:
        """The pieces that begin in the range; long tensors come in pieces of whole blocks, so many tasks can share one."""
        for idx, name, kind, _, _, n_bytes, offset in tensors:
            if offset + n_bytes > data.size:
                raise ValueError(f"{partition.file} ends inside {name}")
            size = BLOCK_SIZES[kind][1]
            step = max(size, self.piece // size * size)
            first = max(0, -(-(partition.start - offset) // step))
            for part in range(first, max(1, -(-n_bytes // step))):
                at = offset + part * step
                # an empty tensor at the end of a file begins in its last range
                if not partition.start <= min(at, data.size - 1) < partition.stop:
                    break
                yield (partition.file, idx, name, kind, part, data.at(at, min(step, n_bytes - part * step)))


class TensorFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tensorfile"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("what", "tensors")]

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_tensor_file(spark: SparkSession, path: str, what: str = "tensors", **options) -> DataFrame:
    """``what`` is kv, tensors or data; ``path`` may hold wildcards and must be visible to all workers."""
    spark.dataSource.register(TensorFiles)
    return spark.read.format("tensorfile").options(what=what, **{k: str(v) for k, v in options.items()}).load(path)
