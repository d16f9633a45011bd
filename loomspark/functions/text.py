"""Text scalars as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK_ENDS = r"^\s+|\s+$"


def strip(c) -> Column:
    """Trim every kind of blank at both ends (``trim`` knows only U+0020)."""
    return F.regexp_replace(c, BLANK_ENDS, "")


def replace_all(c, search: str, new: str) -> Column:
    """Replace every occurrence; an empty search string changes nothing."""
    return F.col(c) if not search and isinstance(c, str) else (c if not search else F.replace(c, F.lit(search), F.lit(new)))


def quote_regex(text: str) -> str:
    """``text`` as a literal Java pattern."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def split_keep_empty(c, sep: str) -> Column:
    """Split on a literal separator; empty pieces and the tail stay."""
    return F.split(c, quote_regex(sep), -1)


def escape_regex(c) -> Column:
    """Put a backslash before every regex metacharacter."""
    return F.regexp_replace(c, r"([.^$|()*+?\[\]{}\\])", r"\\$1")


def ends_with(c, tail: str) -> Column:
    return F.endswith(c, F.lit(tail))


def sortable_stamp(ts) -> Column:
    """``YYYY_MM_DD-HH_MM_SS.nnnnnnnnn``: Spark keeps microseconds, the rest is zero."""
    return F.concat(F.date_format(ts, "yyyy_MM_dd-HH_mm_ss.SSSSSS"), F.lit("000"))


def json_or(doc, path: str, kind: str, default) -> Column:
    """Value at a JSON path, or the default when absent or of another type."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(doc), path, kind), F.lit(default).cast(kind))


def words(c) -> Column:
    """Tokens of the plain word model: pieces between blanks, none empty."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != F.lit(""))


def word_ids(tokens, size: int = 97) -> Column:
    """Toy ids of words: a hash of first character and length, in ``[0, size)``."""
    return F.transform(tokens, lambda w: ((F.ascii(w) * 31 + F.length(w)) % size).cast("int"))


def rough_pieces(c) -> Column:
    """Pieces between blanks and light punctuation, empties counted."""
    return F.size(F.split(c, r"[\s,'\".?]", -1))
