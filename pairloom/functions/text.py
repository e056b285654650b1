"""Text expressions: blanks, and the built-in deterministic tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's ``str.strip`` takes away.
BLANK = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def has_text(text: Column) -> Column:
    """Is there any character that is not white space; false for null."""
    return F.coalesce(text.rlike(f"[^{BLANK}]"), F.lit(False))


def tokens(text: Column) -> Column:
    """Pieces between single spaces; null counts as no text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def token_id(token: Column) -> Column:
    """Number of a token: the first seven hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("int")


def token_ids(text: Column) -> Column:
    return F.transform(tokens(text), token_id)


def padded(ids: Column, length: int, pad: int = 0) -> Column:
    """Cut to ``length`` and filled up with ``pad``."""
    return F.concat(F.slice(ids, 1, length), F.array_repeat(F.lit(pad), F.greatest(F.lit(0), F.lit(length) - F.size(ids))))


def mask(ids: Column, length: int) -> Column:
    """1 for tokens, 0 for padding."""
    n = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))


def mask_length(m: Column) -> Column:
    return F.aggregate(m, F.lit(0), lambda a, x: a + x)


def last_set(m: Column) -> Column:
    """1 + index of the last non-zero entry of a mask, 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(m, lambda x, i: F.when(x != 0, i + 1).otherwise(0))), F.lit(0))
