"""Which letters look alike, from Unicode data.

The list of confusable characters is the Unicode consortium's, as the ICU library
holds it that lies beside Spark's own jars (its spoof checker gives a character's
skeleton; characters of one skeleton look alike). It is read once on the driver.
What NFKC, character names, categories and reading direction say comes from
Python's own Unicode tables.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import SparkSession

#: Scripts whose letters are no look-alikes here: they join, stack or stand for syllables and words beside Latin text.
_OTHER_KIND = regex.compile(
    r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Hangul}\p{Yi}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}"
    r"\p{Thai}\p{Lao}\p{Tibetan}\p{Myanmar}\p{Khmer}\p{Mongolian}\p{Ethiopic}\p{Ahom}\p{Tirhuta}\p{Latin}\p{Common}\p{Inherited}]"
)
_MOST = 0x20000


def _letters() -> list[str]:
    return [c for c in map(chr, range(0x80, _MOST)) if unicodedata.category(c) in ("Lu", "Ll", "Lo") and unicodedata.bidirectional(c) == "L" and not _OTHER_KIND.match(c)]


@lru_cache(maxsize=1)
def _skeletons(spark: SparkSession) -> dict[str, str]:
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    asked = [*_letters(), *map(chr, range(0x41, 0x5B)), *map(chr, range(0x61, 0x7B))]
    return dict(zip(asked, checker.getSkeleton("\n".join(asked)).split("\n")))


def look_alikes(spark: SparkSession) -> dict[str, str]:
    """Letter of another alphabet -> the plain Latin letter that looks like it.

    Where a skeleton has several Latin letters (I and l), case decides; letters
    without case look like capitals.
    """
    skeleton = _skeletons(spark)
    plain: dict[str, list[str]] = {}
    for c, s in skeleton.items():
        if c.isascii():
            plain.setdefault(s, []).append(c)
    out = {}
    for c, s in skeleton.items():
        if not c.isascii() and s in plain:
            out[c] = next((p for p in plain[s] if p.islower() == (unicodedata.category(c) == "Ll")), plain[s][0])
    return out


def styled_letters() -> dict[str, str]:
    """Letters that are a plain Latin letter in another font (bold, script, double-struck), by NFKC."""
    out = {}
    for c in map(chr, range(0x2100, _MOST)):
        if unicodedata.decomposition(c).startswith("<font>"):
            p = unicodedata.normalize("NFKC", c)
            if p.isascii() and p.isalpha():
                out[c] = p
    return out


def small_capitals() -> dict[str, str]:
    """Small capitals, by their names, and the letters that they are."""
    out = {}
    for c in map(chr, [*range(0x250, 0x2B0), *range(0x1D00, 0x1D80), *range(0xA720, 0xA800)]):
        kind, _, letter = unicodedata.name(c, "").partition("SMALL CAPITAL ")
        if kind == "LATIN LETTER " and len(letter) == 1:
            out[c] = letter.lower()
    return out


def compatible_signs() -> dict[str, str]:
    """Signs of general punctuation whose NFKC is one plain sign, such as the one-dot leader."""
    signs = {c: unicodedata.normalize("NFKC", c) for c in map(chr, range(0x2010, 0x2070)) if unicodedata.category(c)[0] == "P"}
    return {c: p for c, p in signs.items() if len(p) == 1 and p.isascii()}
