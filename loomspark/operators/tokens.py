"""Corpus tokenisation.

Splitting text (special tokens, pre-tokenising patterns, normalising) is done with Column expressions.
Only looking pieces up in a vocabulary needs Python: a vocabulary of checked size travels once to each
worker, which remembers the pieces it has seen, so a corpus is tokenised in one scan without a shuffle.
Corpus statistics go further and encode each distinct piece once.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions.text import quote_regex
from loomspark.plans.bounds import collect_bounded, fits
from loomspark.plans.lineage import cut
from loomspark.plans.prefix import neighbour, running_sums

MAX_VOCAB = 2_000_000
#: Pieces that a worker remembers, and how long they may be; longer ones are encoded each time.
CACHE_PIECES, CACHE_LENGTH = 100_000, 40
#: Rows of a batch that are Python objects at a time.
SLICE_ROWS = 256
#: Entries of a vocabulary that is sent to all tasks.
SENT_ENTRIES = 200_000
SPACE_MARK = "\u2581"
#: A noncharacter that no speech holds, around its numbers.
BORDER = "\ufdd0"

# Attribute bits of a vocabulary entry: fixed values.
ATTR_UNKNOWN, ATTR_UNUSED, ATTR_NORMAL, ATTR_CONTROL, ATTR_USER_DEFINED, ATTR_BYTE = 1, 2, 4, 8, 16, 32
ATTR_LSTRIP, ATTR_RSTRIP = 128, 256

# Pre-tokenising patterns by vocabulary family: fixed values, applied in sequence.
_GPT2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)"
_CASES = r"(?:'[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD])"
_LLAMA3 = _CASES + r"|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
_UPPER, _LOWER = r"((?=[\p{L}])([^a-z]))", r"((?=[\p{L}])([^A-Z]))"
_TEKKEN_END = r" ?[^\s\p{L}\p{N}]+[\r\n/]*|\s*[\r\n]+|\s+(?!\S)|\s+"
_BLOOM = r" ?[^(\s|.,!?…。，、।۔،)]+"
PRETOKENIZERS: dict[str, list[str]] = {
    "default": [r"[\p{P}\$\+<=>\^~\|]+", _GPT2, r"\p{N}+", r"[0-9][0-9][0-9]"],
    "llama3": [_LLAMA3],
    "smaug": [_LLAMA3],
    "chatglm4": [_LLAMA3],
    "deepseek-llm": [
        r"[\r\n]",
        r"\s?[A-Za-zµÀ-ÖØ-öø-ƺƼ-ƿǄ-ʓʕ-ʯͰ-ͳͶͷͻ-ͽͿΆΈ-ΊΌΎ-ΡΣ-ϵϷ-ҁҊ-ԯԱ-ՖႠ-ჅᎠ-Ᏽᏸ-ᏽᲐ-ᲺᲽ-Ჿᴀ-ᴫᵫ-ᵷᵹ-ᶚḀ-ἕἘ-Ἕἠ-ὅὈ-Ὅὐ-ὗὙὛὝὟ-ώᾀ-ᾴᾶ-ᾼιῂ-ῄῆ-ῌῐ-ΐῖ-Ίῠ-Ῥῲ-ῴῶ-ῼℂℇℊ-ℓℕℙ-ℝℤΩℨK-ℭℯ-ℴℹℼ-ℿⅅ-ⅉⅎↃↄⰀ-ⱻⱾ-ⳤⳫ-ⳮⳲⳳꙀ-ꙭꚀ-ꚛꜢ-ꝯꝱ-ꞇꞋ-ꞎꭰ-ꮿﬀ-ﬆﬓ-ﬗＡ-Ｚａ-ｚ𐐀-𐑏𐒰-𐓓𐓘-𐓻𐲀-𐲲𐳀-𐳲𑢠-𑣟𞤀-𞥃]+",
        r"\s?[!-/:-~！-／：-～‘-‟　-。]+",
        r"\s+$",
        r"[一-龥ࠀ-一가-퟿]+",
        r"\p{N}+",
    ],
    "deepseek3-llm": [
        r"\p{N}{1,3}",
        r"[一-龥぀-ゟ゠-ヿ]+",
        r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~][A-Za-z]+|[^\r\n\p{L}\p{P}\p{S}]?[\p{L}\p{M}]+| ?[\p{P}\p{S}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+""",
    ],
    "deepseek-coder": [r"[\r\n]", r"\s?\p{L}+", r"\s?\p{P}+", r"[一-龥ࠀ-一가-퟿]+", r"\p{N}"],
    "falcon": [r"[\p{P}\$\+<=>\^~\|`]+", _GPT2, r"[0-9][0-9][0-9]"],
    "starcoder": [r"\p{N}", _GPT2],
    "gpt2": [_GPT2],
    "qwen2": [_LLAMA3.replace(r"\p{N}{1,3}", r"\p{N}")],
    "bloom": [_BLOOM],
    "viking": [_BLOOM, r"\p{N}"],
    "tekken": [
        rf"[^\r\n\p{{L}}\p{{N}}]?{_UPPER}*{_LOWER}+|[^\r\n\p{{L}}\p{{N}}]?{_UPPER}+{_LOWER}*|\p{{N}}|{_TEKKEN_END}"
    ],
    "chameleon": [
        r"<sentinel:[0-9]+>",
        r"(IMGIMG)((A|B|C|D|E|F|G|H|I){1,4})Z",
        r"([\t\n]|    |  )",
        r"\p{N}",
        r"[\p{P}!-/:-@\[-`{-~]",
        _GPT2,
    ],
    "gpt-4o": [
        rf"[^\r\n\p{{L}}\p{{N}}]?{_UPPER}*{_LOWER}+{_CASES}?|[^\r\n\p{{L}}\p{{N}}]?{_UPPER}+{_LOWER}*{_CASES}?|\p{{N}}{{1,3}}|{_TEKKEN_END}"
    ],
    "superbpe": [r"\p{N}+", r"(?=(\d{3})+(?!\d))"],
    "bailingmoe": [
        r"'(?:[sSdDmMtT]|[lL][lL]|[vV][eE]|[rR][eE])|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
    ],
    "seed-coder": [_CASES + r"|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1}| ?[^\s\p{L}\p{N}\r\n]+|\s*[\r\n]+|\s+(?!\S)|\s+"],
}
# Families that share the patterns of another one: fixed values.
ALIASES = {
    "dbrx": "llama3", "refact": "starcoder", "command-r": "starcoder", "smollm": "starcoder", "codeshell": "starcoder",
    "exaone": "starcoder", "minerva": "starcoder", "mpt": "gpt2", "olmo": "gpt2", "jais": "gpt2", "trillion": "gpt2",
    "stablelm2": "qwen2", "poro": "bloom", "gpt3-finnish": "bloom",
}


# ------------------------------------------------------------------ splitting


def _either(pattern: str) -> str:
    """A match of ``pattern`` or, where none begins, the characters up to the next one: all of a text in one pass, in order.

    Whatever a pattern that takes no characters (a look-ahead) finds is a place to cut at.
    """
    gap = rf"(?s:.)(?:(?!{pattern})(?s:.))*+"
    return gap if pattern.startswith("(?:(?=") else f"{pattern}|{gap}"


def _cut(piece: Column, pattern: str) -> Column:
    """Matches and what lies between them, in order; together they are ``piece``, and none is empty."""
    return F.regexp_extract_all(piece, F.lit("(?U)" + _either(pattern)), F.lit(0))


def pretokenize(text, family: str = "default") -> Column:
    """Array of pieces; every pattern of the family splits the pieces of the one before."""
    col = F.col(text) if isinstance(text, str) else text
    first, *others = PRETOKENIZERS[ALIASES.get(family, family)]
    pieces = _cut(col, f"(?:{first})")
    for pattern in others:
        pieces = F.flatten(F.transform(pieces, lambda p: _cut(p, f"(?:{pattern})")))  # noqa: B023
    return pieces


def _raw(text: Column) -> Column:
    return F.struct(F.lit(None).cast("int").alias("id"), text.alias("text"))


def _groups(specials: list[tuple[int, str, int]]) -> list[list[tuple[int, str, int]]]:
    """Specials in order, as long as possible together; those that can overlap without one holding the other stay in turn."""

    def overlap(a: str, b: str) -> bool:
        return any(a[-n:] == b[:n] or b[-n:] == a[:n] for n in range(1, min(len(a), len(b))))

    groups: list[list[tuple[int, str, int]]] = []
    for s in specials:
        blanks = s[2] & (ATTR_LSTRIP | ATTR_RSTRIP)
        if groups and not blanks and not any(g[2] & (ATTR_LSTRIP | ATTR_RSTRIP) or overlap(s[1], g[1]) or g[1] in s[1] for g in groups[-1]):
            groups[-1].append(s)
        else:
            groups.append([s])
    return groups


def partition_special(text, specials: list[tuple[int, str, int]], parse_special: bool) -> Column:
    """Array of fragments (id, text), longest special first: ``id`` is null for raw text, which may hold any character.

    ``specials`` lists (token id, text, attribute bits); control and unknown tokens count only with ``parse_special``.  Specials that
    cannot overlap are looked for in one pass.
    """
    col = F.col(text) if isinstance(text, str) else text
    use = [s for s in specials if parse_special or not s[2] & (ATTR_CONTROL | ATTR_UNKNOWN)]
    frags = F.array(_raw(col))
    blank = r"[ \t\n\x0B\f\r]*"

    def splitter(pattern: str, named: Callable[[Column], Column]):
        one = lambda part: F.when(named(part).isNotNull(), F.struct(named(part).alias("id"), part.alias("text"))).otherwise(_raw(part))
        return lambda f: F.when(f["id"].isNotNull(), F.array(f)).otherwise(F.transform(_cut(f["text"], pattern), one))

    for group in _groups(sorted(use, key=lambda s: (-len(s[1].encode()), s[0]))):
        first: dict[str, int] = {}
        for tid, lit, _ in group:
            first.setdefault(lit, tid)
        attr = group[0][2]  # only a group of one has blanks around it, and its match may hold them
        body = "|".join(quote_regex(lit) for lit in first)
        pattern = (blank if attr & ATTR_LSTRIP else "") + f"(?:{body})" + (blank if attr & ATTR_RSTRIP else "")
        # What lies between matches neither is nor holds a special, so a part tells by itself what it is.
        ids = F.create_map(*[F.lit(x) for lit, tid in first.items() for x in (lit, tid)])
        alone, tid = group[0][1], group[0][0]
        named = (lambda part: F.when(F.contains(part, F.lit(alone)), F.lit(tid))) if attr & (ATTR_LSTRIP | ATTR_RSTRIP) else (lambda part: F.element_at(ids, part))  # noqa: B023
        frags = F.flatten(F.transform(frags, splitter(pattern, named)))
    return F.filter(frags, lambda f: f["id"].isNotNull() | (f["text"] != F.lit("")))


# ------------------------------------------------------------------ normalising


def _is_cjk(cp: int) -> bool:
    # Ranges that stand alone: fixed values.
    return any(
        lo <= cp <= hi
        for lo, hi in (
            (0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F),
            (0x2B920, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F),
        )
    )


class _Normal(dict):
    """Code point -> its normal form, filled on first use; for ``str.translate``."""

    def __missing__(self, cp: int) -> str:
        ch = unicodedata.normalize("NFD", chr(cp))[0]
        cat = unicodedata.category(ch)
        if ch.isspace() and not "\x1c" <= ch <= "\x1f":
            out = " "
        elif ch in "\x00\ufffd" or cat in ("Cc", "Cf", "Co", "Cs"):
            out = ""
        else:
            low = ch.lower()
            out = low if len(low) == 1 else ch
            if cat[0] == "P" or (ord(ch) < 0x7F and cat[0] == "S") or _is_cjk(ord(ch)):
                out = f" {out} "
        self[cp] = out
        return out


def _in_slices(values: pa.Array, fn: Callable, kind: pa.DataType) -> pa.Array:
    """``fn`` of each value; only a slice at a time is Python objects."""
    parts = [pa.array(map(fn, values.slice(at, SLICE_ROWS).to_pylist()), kind) for at in range(0, len(values), SLICE_ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@F.arrow_udf(T.ArrayType(T.StringType()))
def normal_words(texts: pa.Array) -> pa.Array:
    """Lower-cased words without accents; punctuation, ASCII symbols and CJK stand alone."""
    table = _Normal()
    return _in_slices(texts, lambda s: s.translate(table).split(), pa.list_(pa.string()))


# ------------------------------------------------------------------ vocabularies


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


BYTE_CHARS = _byte_chars()


def byte_text(s: str) -> str:
    return "".join(BYTE_CHARS[b] for b in s.encode())


@dataclass
class Vocab:
    """A vocabulary in one worker; ``kind`` is bpe, spm, wpm, ugm or rwkv."""

    kind: str
    ids: dict[str, int]
    scores: dict[int, float] = field(default_factory=dict)
    attrs: dict[int, int] = field(default_factory=dict)
    ranks: dict[tuple[str, str], int] = field(default_factory=dict)
    unk: int = 0
    bos: int | None = None
    eos: int | None = None
    sep: int | None = None
    family: str = "default"
    space_prefix: bool = True
    ignore_merges: bool = False

    def specials(self) -> list[tuple[int, str, int]]:
        want = ATTR_CONTROL | ATTR_USER_DEFINED | ATTR_UNKNOWN
        return [(i, t, self.attrs[i]) for t, i in self.ids.items() if self.attrs.get(i, ATTR_NORMAL) & want]


def load_vocab(tokens: DataFrame, kind: str, merges: DataFrame | None = None, **options) -> Vocab:
    """A vocabulary from tables ``(token_id, text, score, attr)`` and ``(rank, left, right)``, size checked."""
    rows = collect_bounded(tokens.select("token_id", "text", "score", "attr"), MAX_VOCAB, "vocabulary")
    pairs = collect_bounded(merges.select("rank", "left", "right"), MAX_VOCAB, "merges") if merges is not None else []
    return Vocab(
        kind,
        {r.text: r.token_id for r in rows},
        {r.token_id: r.score for r in rows},
        {r.token_id: r.attr for r in rows},
        {(r.left, r.right): r.rank for r in pairs},
        **options,
    )


def _merge(parts: list[str], priority: Callable[[str, str], float | None]) -> list[str]:
    """Join neighbours, lowest priority first and leftmost among equals, until nothing joins."""
    nxt, prv = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list = []

    def push(i: int) -> None:
        j = nxt[i] if i >= 0 else len(parts)
        if j < len(parts) and (p := priority(parts[i], parts[j])) is not None:
            heapq.heappush(queue, (p, i, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        push(i)
    while queue:
        _, i, text = heapq.heappop(queue)
        j = nxt[i]
        if not parts[i] or j >= len(parts) or parts[i] + parts[j] != text:
            continue
        parts[i], parts[j] = text, ""
        nxt[i] = nxt[j]
        if nxt[i] < len(parts):
            prv[nxt[i]] = i
        push(prv[i])
        push(i)
    return [p for p in parts if p]


def _bpe(v: Vocab, piece: str) -> list[int]:
    s = byte_text(piece)
    if v.ignore_merges and s in v.ids:
        return [v.ids[s]]
    out: list[int] = []
    for part in _merge(list(s), lambda a, b: v.ranks.get((a, b))):
        out += [v.ids[part]] if part in v.ids else [v.ids[c] for c in part if c in v.ids]
    return out


def _spm(v: Vocab, piece: str) -> list[int]:
    def rank(a: str, b: str) -> float | None:
        tid = v.ids.get(a + b)
        return None if tid is None else -v.scores[tid]

    out: list[int] = []
    for part in _merge(list(piece), rank):
        out += [v.ids[part]] if part in v.ids else [v.ids[f"<0x{b:02X}>"] for b in part.encode()]
    return out


def _wpm(v: Vocab, word: str) -> list[int]:
    s, i, out = SPACE_MARK + word, 0, []
    longest = v.longest
    while i < len(s):
        for j in range(min(len(s), i + longest), i, -1):
            if s[i:j] in v.ids:
                out.append(v.ids[s[i:j]])
                i = j
                break
        else:
            return [v.unk]
    return out


def _ugm(v: Vocab, s: str) -> list[int]:
    floor = v.floor
    best: list[tuple[float, int, int]] = [(0.0, v.unk, 0)] + [(float("-inf"), v.unk, 0)] * len(s)
    for i in range(len(s)):
        here = best[i][0]
        single = False
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            tid = v.ids.get(s[i:j])
            if tid is None:
                continue
            single |= j == i + 1
            score = here + (0.0 if v.attrs.get(tid, 0) & ATTR_USER_DEFINED else v.scores[tid])
            if score > best[j][0]:
                best[j] = (score, tid, i)
        if not single and here + floor > best[i + 1][0]:
            best[i + 1] = (here + floor, v.unk, i)
    out, at = [], len(s)
    while at > 0:
        _, tid, start = best[at]
        out.append(tid)
        at = start
    return out[::-1]


def _rwkv(v: Vocab, s: str) -> list[int]:
    raw, i, out = s.encode().decode("latin-1"), 0, []
    while i < len(raw):
        for j in range(min(len(raw), i + v.longest), i, -1):
            if raw[i:j] in v.ids:
                out.append(v.ids[raw[i:j]])
                i = j
                break
        else:
            out.append(v.unk)
            i += 1
    return out


ENCODERS = {"bpe": _bpe, "spm": _spm, "wpm": _wpm, "ugm": _ugm, "rwkv": _rwkv}


def _encoder(v: Vocab) -> Callable[[str], list[int]]:
    v.longest = max(map(len, v.ids))
    # an unknown character costs ten more than the worst entry
    v.floor = min((x for i, x in v.scores.items() if v.attrs.get(i, ATTR_NORMAL) & ATTR_NORMAL), default=0.0) - 10.0
    fn, seen = ENCODERS[v.kind], {}

    def encode(piece: str) -> list[int]:
        got = seen.get(piece)
        if got is None:
            got = fn(v, piece)
            if len(piece) <= CACHE_LENGTH and len(seen) < CACHE_PIECES:
                seen[piece] = got
        return got

    return encode


def pieces(text, v: Vocab, parse_special: bool = False) -> Column:
    """Pieces (id, text) that can be encoded on their own; ``id`` is set for special tokens.

    Score-based kinds may be cut in front of a blank mark unless an entry reaches across one.
    """
    frags = partition_special(text, v.specials(), parse_special)
    split = lambda f, parts: F.when(f["id"].isNotNull(), F.array(f)).otherwise(F.transform(parts, _raw))
    if v.kind == "bpe":
        return F.flatten(F.transform(frags, lambda f: split(f, pretokenize(f["text"], v.family))))
    if v.kind in ("wpm", "rwkv"):
        return frags  # words of the first are normalised in front of the lookup
    spans = any(SPACE_MARK in t.lstrip(SPACE_MARK) for t, i in v.ids.items() if not v.attrs.get(i, 0) & ATTR_CONTROL)

    def mark(f: Column, i: Column) -> Column:
        lead = F.lit("")
        if v.space_prefix:
            after_special = (i == 0) | F.get(frags, i - 1)["id"].isNotNull()
            lead = F.when(after_special, F.lit(" ")).otherwise(F.lit(""))
        whole = F.replace(F.concat(lead, f["text"]), F.lit(" "), F.lit(SPACE_MARK))
        return F.array(whole) if spans else F.regexp_extract_all(whole, F.lit(f"({SPACE_MARK}+[^{SPACE_MARK}]*|^[^{SPACE_MARK}]+)"))

    return F.flatten(F.transform(frags, lambda f, i: split(f, mark(f, i))))


def tokenize_corpus(
    df: DataFrame, v: Vocab, *, doc: str = "doc_id", text: str = "text", add_special: bool = True, parse_special: bool = False
) -> DataFrame:
    """``(doc, tokens, double_bos, double_eos)`` for every row."""
    src = df.select(doc, pieces(F.col(text), v, parse_special).alias("pieces"))
    src = src.select(doc, F.col("pieces.id").alias("ids"), F.col("pieces.text").alias("texts"))
    shared = df.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        encode, table = _encoder(vocab), _Normal()

        def one(special, texts) -> list[int]:
            out: list[int] = []
            for known, p in zip(special, texts):
                if known is not None:
                    out.append(known)
                elif vocab.kind == "wpm":
                    for w in p.translate(table).split():
                        out += encode(w)
                else:
                    ids = encode(p)
                    if vocab.kind == "ugm" and out and ids and out[-1] == vocab.unk:
                        ids = ids[1:] if ids[0] == vocab.unk else ids
                    out += ids
            if vocab.kind == "ugm":
                out = [t for i, t in enumerate(out) if not (i and t == vocab.unk == out[i - 1])]
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                keys, specials, texts = batch.slice(at, SLICE_ROWS).columns
                tokens = pa.array([one(i, t) for i, t in zip(specials.to_pylist(), texts.to_pylist())], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, tokens], [doc, "tokens"])

    ids = src.mapInArrow(run, f"{doc} {df.schema[doc].dataType.simpleString()}, tokens array<int>")
    if not add_special:
        return ids.select(doc, "tokens", F.lit(False).alias("double_bos"), F.lit(False).alias("double_eos"))
    tail = v.sep if v.kind == "wpm" else v.eos
    return add_special_tokens(ids, bos=v.bos, eos=tail)


def add_special_tokens(df: DataFrame, *, bos: int | None, eos: int | None, tokens: str = "tokens") -> DataFrame:
    """Put BOS in front and EOS behind; flags tell whether the text brought its own."""
    t = F.col(tokens)
    none = F.array().cast("array<int>")
    head = F.array(F.lit(bos)) if bos is not None else none
    tail = F.array(F.lit(eos)) if eos is not None else none
    return (
        df.withColumn("double_bos", F.coalesce(F.get(t, F.lit(0)) == bos, F.lit(False)) if bos is not None else F.lit(False))
        .withColumn("double_eos", F.coalesce(F.try_element_at(t, F.lit(-1)) == eos, F.lit(False)) if eos is not None else F.lit(False))
        .withColumn(tokens, F.concat(head, t, tail))
    )


def piece_bytes(v: Vocab, special: bool = False) -> dict[int, bytes]:
    """What each token stands for; control and unknown tokens for nothing unless ``special``."""
    back = {c: b for b, c in BYTE_CHARS.items()}
    raw: dict[int, bytes] = {}
    for t, i in v.ids.items():
        attr = v.attrs.get(i, ATTR_NORMAL)
        if attr & (ATTR_CONTROL | ATTR_UNKNOWN):
            raw[i] = t.encode() if special else b""
        elif attr & ATTR_USER_DEFINED:
            raw[i] = t.encode()
        elif attr & ATTR_BYTE:
            raw[i] = bytes([int(t[3:5], 16)])
        elif v.kind == "bpe":
            raw[i] = bytes(back[c] for c in t)
        elif v.kind == "rwkv":
            raw[i] = t.encode("latin-1")
        else:
            raw[i] = t.replace(SPACE_MARK, " ").encode()
    return raw


def join_pieces(df: DataFrame, pieces: DataFrame, *, doc: str = "doc_id", tokens: str = "tokens", drop_space: bool = False) -> DataFrame:
    """``(doc, text)`` of ids and ``pieces(token_id, raw binary)``: the bytes of a document in order, decoded once; ``doc`` is its key.

    Ids without a piece stand for nothing, bytes that are no UTF-8 for U+FFFD.  ``drop_space`` leaves out a blank that the
    first token begins with.  Tokens meet their pieces by a join, broadcast by size, and go back to their document.
    """
    each = df.select(doc, F.posexplode_outer(tokens).alias("pos", "token_id")).join(pieces.select("token_id", F.hex("raw").alias("raw")), "token_id", "left")
    parts = each.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("raw", F.lit("")).alias("raw")))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: p["raw"]), "")
    if drop_space:
        whole = F.when(F.startswith(F.get("parts", F.lit(0))["raw"], F.lit("20")), F.substring(whole, 3, (1 << 31) - 1)).otherwise(whole)
    return parts.select(doc, F.make_valid_utf8(F.unhex(whole).cast("string")).alias("text"))


def detokenize(df: DataFrame, v: Vocab, *, doc: str = "doc_id", tokens: str = "tokens", special: bool = False) -> DataFrame:
    """``(doc, text)`` of each row: bytes of all its tokens are joined before they are decoded; nothing is shuffled.

    Ids that the vocabulary does not have stand for nothing, bytes that are no UTF-8 for U+FFFD.
    """
    shared = df.sparkSession.sparkContext.broadcast(piece_bytes(v, special))
    drop_space = v.space_prefix and v.kind in ("spm", "ugm", "wpm")

    @F.arrow_udf(T.BinaryType())
    def joined(ids: pa.Array) -> pa.Array:
        raw = shared.value

        def one(seq: list[int] | None) -> bytes:
            seq = seq or []
            whole = b"".join([raw.get(i, b"") for i in seq])
            return whole[1:] if drop_space and seq and raw.get(seq[0], b"").startswith(b" ") else whole

        return _in_slices(ids, one, pa.binary())

    return df.select(doc, F.make_valid_utf8(joined(tokens).cast("string")).alias("text"))


# ------------------------------------------------------------------ tables around tokens


def token_report(df: DataFrame, vocab: DataFrame, *, doc: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``(doc, pos, token_id, piece, invalid_utf8, total)``; ``vocab(token_id, raw binary)`` is computed once and sent to the tokens where it is small."""
    vocab = cut(vocab)
    vocab = F.broadcast(vocab) if fits(vocab, SENT_ENTRIES) else vocab
    rows = df.select(doc, F.size(tokens).alias("total"), F.posexplode(tokens).alias("pos", "token_id"))
    raw = F.col("raw")
    return rows.join(vocab, "token_id", "left").select(
        doc, "pos", "token_id", F.decode(raw, "UTF-8").alias("piece"), (~F.is_valid_utf8(raw.cast("string"))).alias("invalid_utf8"), "total"
    )


def looks_special(text) -> Column:
    """Entries that ought to be control tokens by their form."""
    c = F.col(text) if isinstance(text, str) else text
    # Fixed values.
    named = c.isin("<pad>", "<mask>", "<2mass>", "[@BOS@]")
    return named | c.rlike(r"(?s)^<\|(.*\|)?>$|^<｜(.*｜)?>$|^<unused.*>$")


def vocabulary_table(vocab: DataFrame, size: int) -> DataFrame:
    """``(token_id, text, attr)`` for every id below ``size``; ``vocab(token_id, text, added, special)``.

    Missing ids become unused padding entries; added ones are control or user-defined.
    """
    ids = vocab.sparkSession.range(size).select(F.col("id").cast("int").alias("token_id"))
    rows = ids.join(vocab, "token_id", "left")
    control = F.col("special") | looks_special("text")
    attr = (
        F.when(F.col("text").isNull(), ATTR_UNUSED)
        .when(~F.col("added"), ATTR_NORMAL)
        .when(control, ATTR_CONTROL)
        .otherwise(ATTR_USER_DEFINED)
    )
    text = (
        F.when(F.col("text").isNull(), F.concat(F.lit("[PAD"), F.col("token_id").cast("string"), F.lit("]")))
        .when(F.col("added") & ~control, F.replace("text", F.lit(SPACE_MARK), F.lit(" ")))
        .otherwise(F.col("text"))
    )
    return rows.select("token_id", text.alias("text"), attr.alias("attr"))


def fingerprint(tokens) -> Column:
    """sha256 of the id list as it prints."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.sha2(F.concat(F.lit("["), F.array_join(t.cast("array<string>"), ", "), F.lit("]")), 256)


def parse_prompts(df: DataFrame, prompt: str, *, key: str = "prompt_id") -> DataFrame:
    """Parts ``(key, prompt_no, part_no, token_id, text, with_special)`` of JSON prompts.

    A prompt is a string, a list of ids, a mix of both, or a list of prompts.  Only a string in first place gets special tokens.
    """
    v = F.try_parse_json(prompt)
    kind = F.schema_of_variant(v)
    items = F.from_json(F.when(kind.startswith("ARRAY"), F.col(prompt)).otherwise(F.concat(F.lit("["), F.col(prompt), F.lit("]"))), "array<variant>")
    is_num, is_str = (lambda x: F.schema_of_variant(x) == "BIGINT"), (lambda x: F.schema_of_variant(x) == "STRING")
    n_num, n_str = F.size(F.filter("items", is_num)), F.size(F.filter("items", is_str))
    one_prompt = (n_num == F.size("items")) | ((n_num > 0) & (n_str > 0))
    nested = F.transform("items", lambda x: F.when(F.schema_of_variant(x).startswith("ARRAY"), F.try_variant_get(x, "$", "array<variant>")).otherwise(F.array(x)))
    prompts = F.when(one_prompt, F.array(F.col("items"))).otherwise(nested)
    rows = df.select(key, items.alias("items")).select(key, F.posexplode(prompts).alias("prompt_no", "parts"))
    parts = rows.select(key, "prompt_no", F.posexplode("parts").alias("part_no", "part"))
    return parts.select(
        key,
        "prompt_no",
        "part_no",
        F.when(is_num(F.col("part")), F.try_variant_get("part", "$", "int")).alias("token_id"),
        F.when(is_str(F.col("part")), F.try_variant_get("part", "$", "string")).alias("text"),
        (is_str(F.col("part")) & (F.col("part_no") == 0)).alias("with_special"),
    )


def tokenize_prompts(df: DataFrame, prompt: str, v: Vocab, *, key: str = "prompt_id", parse_special: bool = True) -> DataFrame:
    """``(key, prompt_no, tokens)`` of JSON prompts."""
    parts = parse_prompts(df, prompt, key=key)
    at = F.struct(key, "prompt_no", "part_no")
    texts = parts.filter("text IS NOT NULL").select(F.to_json(at).alias("at"), "text", "with_special")
    ids = tokenize_corpus(texts, v, doc="at", add_special=False, parse_special=parse_special)
    bos = F.array(F.lit(v.bos)) if v.bos is not None else F.array().cast("array<int>")
    filled = parts.withColumn("at", F.to_json(at)).join(ids.select("at", "tokens"), "at", "left")
    toks = F.when(F.col("text").isNull(), F.array("token_id")).when(F.col("with_special"), F.concat(bos, F.col("tokens"))).otherwise(F.col("tokens"))
    grouped = filled.groupBy(key, "prompt_no").agg(F.array_sort(F.collect_list(F.struct("part_no", toks.alias("toks")))).alias("parts"))
    return grouped.select(key, "prompt_no", F.flatten(F.transform("parts", lambda p: p["toks"])).alias("tokens"))


def token_frequencies(df: DataFrame, v: Vocab, *, text: str = "text", parse_special: bool = False) -> DataFrame:
    """``(token_id, cnt)`` over the corpus: each distinct piece is encoded once and weighed by its count."""
    each = df.select(F.explode(pieces(F.col(text), v, parse_special)).alias("p")).select("p.id", F.col("p.text").alias("piece"))
    counted = each.groupBy("id", "piece").agg(F.count("*").alias("n"))
    ids = tokenize_pieces(counted, v)
    return ids.select("n", F.explode("tokens").alias("token_id")).groupBy("token_id").agg(F.sum("n").alias("cnt"))


def tokenize_pieces(counted: DataFrame, v: Vocab) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(shared.value)
        for pdf in batches:
            toks = [encode(p) if pd.isna(known) else [int(known)] for known, p in zip(pdf["id"], pdf["piece"])]
            yield pd.DataFrame({"piece": pdf["piece"], "n": pdf["n"], "tokens": toks})

    return counted.select("id", "piece", "n").mapInPandas(run, "piece string, n long, tokens array<int>")


def token_statistics(df: DataFrame, *, doc: str = "doc_id", tokens: str = "tokens", unknown: int = 0) -> DataFrame:
    """Per document: tokens, distinct tokens and the share of the unknown token."""
    t = F.col(tokens)
    n = F.size(t)
    unk = F.size(F.filter(t, lambda x: x == unknown))
    return df.select(doc, n.alias("n"), F.size(F.array_distinct(t)).alias("n_distinct"), F.try_divide(unk.cast("double"), n).alias("unknown_rate"))


# Flag of each general category: fixed values.
CATEGORY_FLAGS = {"L": 0x0004, "M": 0x0010, "N": 0x0002, "P": 0x0020, "S": 0x0040, "Z": 0x0008, "C": 0x0080}


def category_flags(ch) -> Column:
    c = F.col(ch) if isinstance(ch, str) else ch
    out = F.when(c.rlike(r"^\p{Cn}$"), 0x0001)
    for cat, flag in CATEGORY_FLAGS.items():
        out = out.when(c.rlike(rf"^\p{{{cat}}}$"), flag)
    return out


def equal_ranges(df: DataFrame, value: str, *, point: str = "cp") -> DataFrame:
    """``(first, last, value)``: runs of consecutive points with one value; ``df`` holds each point once."""
    prev = neighbour(df, [], point, [value], -1)
    opens = F.when(F.col(f"prev_{value}").eqNullSafe(F.col(value)), 0).otherwise(1).cast("long")
    runs = running_sums(prev, [], point, {"run": opens})
    return runs.groupBy("run").agg(F.min(point).alias("first"), F.max(point).alias("last"), F.first(value).alias(value)).drop("run")


@F.pandas_udf(T.IntegerType())
def first_of_nfd(ch: pd.Series) -> pd.Series:
    """First code point of the decomposed character."""
    return ch.map(lambda c: ord(unicodedata.normalize("NFD", c)[0])).astype("int32")


def distinct_codepoints(df: DataFrame, text: str = "text") -> DataFrame:
    """``(cp, ch)``: every code point of the texts, once."""
    chars = df.select(F.explode(F.array_distinct(F.split(text, ""))).alias("ch")).filter(F.col("ch") != "").distinct()
    return chars.select(F.ascii("ch").alias("cp"), "ch")


# ------------------------------------------------------------------ speech text

# English number words: fixed values.
ONES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
        "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
TENS = ["", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]
SCALES = [(1_000_000_000, " billion "), (1_000_000, " million "), (1_000, " thousand ")]


def _below_thousand(n: Column) -> Column:
    ones, tens = F.array(*map(F.lit, ONES)), F.array(*map(F.lit, TENS))
    word = lambda i: F.get(ones, i.cast("int"))
    low = n % 100
    hundreds = F.when(n >= 100, F.concat(word(F.floor(n / 100)), F.lit(" hundred "))).otherwise("")
    ten = F.get(tens, F.floor(low / 10).cast("int"))
    small = (
        F.when((low >= 20) & (low % 10 > 0), F.concat(ten, F.lit("-"), word(low % 10)))
        .when(low >= 20, ten)
        .when(low > 0, word(low))
        .otherwise("")
    )
    return F.concat(hundreds, small)


def number_words(number) -> Column:
    """A decimal number in English; an integer part that does not fit 32 bits gives a blank."""
    head = F.regexp_extract(number, r"^(\d+)", 1)
    n = F.when(F.length(F.regexp_replace(head, "^0+", "")) <= 10, head.cast("decimal(38,0)").cast("long"))
    out, rest = F.lit(""), n
    for size, name in SCALES:
        out = F.concat(out, F.when(rest >= size, F.concat(_below_thousand(F.floor(rest / size)), F.lit(name))).otherwise(""))
        rest = rest % size
    out = F.when(n == 0, F.lit(ONES[0])).otherwise(F.concat(out, _below_thousand(rest)))
    digits = F.split(F.regexp_extract(number, r"\.(\d+)$", 1), "")
    ones = F.array(*map(F.lit, ONES))
    said = F.array_join(F.transform(F.filter(digits, lambda d: d != ""), lambda d: F.concat(F.lit(" "), F.get(ones, d.cast("int")))), "")
    decimals = F.when(F.contains(number, F.lit(".")), F.concat(F.lit(" point"), said)).otherwise("")
    return F.when(n.isNull() | (n > 2_147_483_647), F.lit(" ")).otherwise(F.concat(out, decimals))


def speech_text(text, separator: str = "<|text_sep|>") -> Column:
    """Text for speech: numbers as words, letters a-z only, one separator between words."""
    col = F.col(text) if isinstance(text, str) else text
    marked = F.split(F.regexp_replace(col, r"[0-9]+(\.[0-9]+)?", f"{BORDER}$0{BORDER}"), BORDER, -1)
    said = F.array_join(F.transform(marked, lambda p: F.when(p.rlike(r"^[0-9]+(\.[0-9]+)?$"), number_words(p)).otherwise(p)), "")
    low = F.translate(said, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = F.regexp_replace(low, r"[-_/,\.\\]", " ")
    out = F.regexp_replace(out, r"[^a-z\s]", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\s+", " "), r"^\s+|\s+$", "")
    return F.regexp_replace(out, r"\s", separator.replace("$", r"\$"))
