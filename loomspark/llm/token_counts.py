"""Token counts by a compiled tokenizer.

A byte-pair vocabulary is compiled, state by state as texts need it, to a deterministic transducer over the bytes of a
piece.  Its state is all that later bytes can still change: the longest end of the piece so far that some token begins
with, and the last token and relative count at each place in it.  A transition carries the number of tokens it emits,
so the count of a piece is the sum along its path; no merge is ever carried out on a text.

Above the pieces stand the blanks, where the machine is back in its first state.  A chunk of a text is therefore
summed up by a small state map: the bytes before its first blank, the count between its first and last blank, and the
bytes after the last.  Maps compose associatively, so a long text is cut in chunks that are mapped in
parallel and joined by a prefix scan of the maps.
"""

from __future__ import annotations

import json
import unicodedata
from functools import reduce

import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import map_rows, row_key

#: Code points of a chunk; longer texts are cut and their chunks dealt out anew.
CHUNK = 32_768
#: Entries a memo of a task holds before it is emptied.
MEMO = 400_000
LONG = 64

# White space of the pattern language of the tokenizer file (the Unicode property).
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class PieceCounter:
    """Transducer over the symbols of a piece; symbols 0-255 are bytes, 256-511 bytes that end a piece."""

    def __init__(self, merges: list, end: str):
        symbols = byte_symbols()
        names = {s: b for b, s in enumerate(symbols)} | {s + end: 256 + b for b, s in enumerate(symbols)}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: list[tuple[int, ...]] = [(b,) for b in range(512)]
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            if a + b not in names:
                names[a + b] = len(self.parts)
                self.parts.append(self.parts[names[a]] + self.parts[names[b]])
            self.merge.setdefault((names[a], names[b]), (rank, names[a + b]))
        self.token = {p: t for t, p in enumerate(self.parts)}
        self.starts = {p[:n] for p in self.parts for n in range(1, len(p) + 1)}
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((), (None,), (0,))
        self.states, self.ids, self.steps = [start], {start: 0}, {}

    def whole(self, parts: tuple[int, ...]) -> list[int]:
        """Tokens of a short run of symbols by carrying out its merges; only ever used on one or two tokens."""
        ids = list(parts)
        while len(ids) > 1:
            best = min((self.merge[p][0] for p in zip(ids, ids[1:]) if p in self.merge), default=None)
            if best is None:
                break
            out, k = [], 0
            while k < len(ids):
                found = self.merge.get((ids[k], ids[k + 1])) if k + 1 < len(ids) else None
                if found and found[0] == best:
                    out.append(found[1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def follows(self, last: int | None, token: int) -> bool:
        """Whether ``token`` can stand behind ``last`` in an encoding: exactly if their joint text is encoded as the two."""
        key = (last, token)
        if (known := self.fits.get(key)) is None:
            pair = [token] if last is None else [last, token]
            known = self.fits[key] = self.whole(sum((self.parts[t] for t in pair), ())) == pair
        return known

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, tokens emitted); a symbol that ends the piece emits all that is still open."""
        tail, lasts, counts = self.states[state]
        tail = (*tail, symbol)
        for begin in range(len(tail)):
            token = self.token.get(tail[begin:])
            if token is not None and self.follows(lasts[begin], token):
                break
        lasts, counts = (*lasts, token), (*counts, counts[begin] + 1)
        if symbol >= 256:
            return 0, counts[-1]
        drop = 0
        while drop < len(tail) and tail[drop:] not in self.starts:
            drop += 1
        emitted = counts[drop]
        key = (tail[drop:], lasts[drop:], tuple(c - emitted for c in counts[drop:]))
        known = self.ids.get(key)
        if known is None:
            known = self.ids[key] = len(self.states)
            self.states.append(key)
        return known, emitted

    def count(self, piece: bytes) -> int:
        if len(self.steps) > 4 * MEMO:
            self.reset()
        steps, state, total = self.steps, 0, 0
        for b in piece[:-1]:
            key = state << 9 | b
            found = steps.get(key)
            if found is None:
                found = steps[key] = self.step(state, b)
            state = found[0]
            total += found[1]
        key = state << 9 | 256 | piece[-1]
        found = steps.get(key)
        if found is None:
            found = steps[key] = self.step(state, 256 | piece[-1])
        return total + found[1]


class Counter:
    """Counts of texts by a tokenizer file with word ends: special strings, normal form, pieces, transducer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE" or split["behavior"] != "Removed":
            raise ValueError(f"{path}: not a vocabulary with word ends")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.marks = [s[:2] for s in special]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)))
        self.machine = PieceCounter(spec["model"]["merges"], spec["model"]["end_of_word_suffix"])
        self.of_piece: dict[str, int] = {}
        self.of_word: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        n = self.of_piece.get(piece)
        if n is None:
            n = self.machine.count(piece.encode("utf-8", "replace"))
            if len(piece) <= LONG:
                if len(self.of_piece) >= MEMO:
                    self.of_piece.clear()
                self.of_piece[piece] = n
        return n

    def plain(self, word: str) -> int:
        """Tokens of a run without blanks and special strings."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")  # letter by letter, so no final form
        return sum(map(self.piece, self.pieces(word.lower())))

    def word(self, word: str) -> int:
        """Tokens of a run without blanks; blanks part pieces, so runs can be counted one by one."""
        n = self.of_word.get(word)
        if n is None:
            if any(m in word for m in self.marks):
                rest = self.special.split(word)
                n = len(rest) - 1 + sum(map(self.plain, rest))
            else:
                n = self.plain(word)
            if len(word) <= LONG:
                if len(self.of_word) >= MEMO:
                    self.of_word.clear()
                self.of_word[word] = n
        return n

    def state_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(run before the first blank, count between, run after the last blank); no blank: (chunk, 0, None)."""
        runs = chunk.split() if chunk.isascii() and not any(c in chunk for c in "\x1c\x1d\x1e\x1f") else None
        if runs is None:
            runs = SPACE.split(chunk)
        else:
            runs = [""] * (not runs or chunk[0] != runs[0][0]) + runs + [""] * (not runs or chunk[-1] != runs[-1][-1])
            if not chunk:
                runs = [""]
        if len(runs) == 1:
            return runs[0], 0, None
        return runs[0], sum(map(self.word, runs[1:-1])), runs[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        if b[2] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.word(a[2] + b[0]) + b[1], b[2]

    def total(self, state_map: tuple) -> int:
        """Tokens of a text whose whole is mapped: what is open at both ends is closed."""
        head, middle, tail = state_map
        return self.word(head) + middle + self.word(tail or "")

    def count(self, text: str) -> int:
        return self.total(self.state_map(text))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One compiled counter for each worker process and file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for each row of ``docs``.

    Texts up to ``chunk`` code points are counted where they are read.  Longer ones are cut, their chunks are dealt out
    by text and place, mapped, and the maps composed in two levels, so no task works through a whole long text.
    A null text counts as empty; null ids stay; repeated rows each give a row; an empty table gives an empty table;
    other columns are not read.  The file at ``path`` has to lie at the same place on all executors.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    is_short = F.length("text") <= chunk
    short = map_rows(docs.filter(is_short).select("doc_id", size.alias("n_bytes"), "text"), lambda: _short(path), "doc_id long, n_bytes long, n_tokens long")
    return short.unionByName(_long(docs.filter(~is_short), path, chunk)).withColumn("over_limit", F.col("n_tokens") > limit)


def _short(path):
    count = counter(path).count
    return lambda doc_id, n_bytes, text: (doc_id, n_bytes, count(text))


def _long(docs: DataFrame, path: str, size: int) -> DataFrame:
    key = row_key(F.col("doc_id"), F.xxhash64("text"), F.length("text"))
    cut = map_rows(docs.select(key.alias("key"), "doc_id", "text"), lambda: lambda key, doc_id, text: (key, doc_id, len(text.encode("utf-8", "replace")), [text[k : k + size] for k in range(0, len(text), size)]), "key string, doc_id long, n_bytes long, chunks array<string>")
    # Rows that repeat share a key: their chunks are counted once and the row is told as often as it was there.
    chunks = cut.select("key", "doc_id", "n_bytes", F.posexplode("chunks").alias("place", "chunk"))
    chunks = chunks.groupBy("key", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.first("chunk").alias("chunk"), F.count(F.lit(1)).alias("times"))
    maps = map_rows(chunks, lambda: _mapper(path), "key string, place int, doc_id long, n_bytes long, times long, head string, middle long, tail string")
    for level in (256, None):
        group = F.floor(F.col("place") / level).cast("int") if level else F.lit(0)
        row = F.sort_array(F.collect_list(F.struct("place", "head", "middle", "tail"))).alias("maps")
        grouped = maps.groupBy("key", group.alias("place")).agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.first("times").alias("times"), row)
        maps = map_rows(grouped, lambda: _composer(path), "key string, place int, doc_id long, n_bytes long, times long, head string, middle long, tail string")
    closed = map_rows(maps.select("doc_id", "n_bytes", "times", "head", "middle", "tail"), lambda: _closer(path), "doc_id long, n_bytes long, times int, n_tokens long")
    return closed.select("doc_id", "n_bytes", "n_tokens", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("__time")).drop("__time")


def _mapper(path):
    state_map = counter(path).state_map
    return lambda key, place, doc_id, n_bytes, chunk, times: (key, place, doc_id, n_bytes, times, *state_map(chunk))


def _composer(path):
    compose = counter(path).compose
    return lambda key, place, doc_id, n_bytes, times, maps: (key, place, doc_id, n_bytes, times, *reduce(compose, [(m["head"], m["middle"], m["tail"]) for m in maps]))


def _closer(path):
    total = counter(path).total
    return lambda doc_id, n_bytes, times, head, middle, tail: (doc_id, n_bytes, times, total((head, middle, tail)))
