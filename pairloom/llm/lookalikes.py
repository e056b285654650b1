"""Problem 1: text that looks the same but is stored with other characters.

Every token's *resolved script set* is the intersection of the scripts in which
each of its letters can be spelled (a Cyrillic "о" can be spelled in Cyrillic or,
by its look-alike, in Latin). A token whose letters come from several scripts is
a mixed-script confusable; a token all of whose letters have look-alikes in
another script is a whole-script confusable and is decided by its neighbours.
The consistent spelling is written, and the remaining forms (full width,
ligatures, number letters, combining accents, invisible characters, special
spaces and hyphens) are normalised.

The letters that differ most in shape from what they are mistaken for are fixed
values here; all others come from the Unicode data of :mod:`confusables`.

Expressions in the JVM decide which texts can hold a case at all: those with a
character that the function may act on. They are derived from the same tables as
the function. Only those texts reach Python, in Arrow batches. There is no shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.confusables import compatible_signs, look_alikes, small_capitals, styled_letters

# Look-alike letters. Lower case first, then capitals.
CYRILLIC_LATIN = dict(zip("аеорсухіјѕһԁԛԝѵӏАВЕКМНОРСТУХІЈЅҮԌԚԜ", "aeopcyxijshdqwvlABEKMHOPCTYXIJSYGQW"))
GREEK_LATIN = dict(zip("ανορυικγΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "avopuikyABEZHIKMNOPTYX"))
LATIN_LATIN = dict(zip("ɡɑɩƖƽßÐƉ", "gailsßĐĐ"))
ARMENIAN_LATIN = dict(zip("օոսհցզՕՍԼ", "onuhgqOUL"))
# Letters that Russian does not have; in a wholly Cyrillic token they speak for a look-alike.
NOT_RUSSIAN = set("іјѕһԁԛԝѵӏІЈЅҮԌԚԜ")
LATIN_CYRILLIC = {v: k for k, v in CYRILLIC_LATIN.items() if k not in NOT_RUSSIAN}
LATIN_GREEK = {v: k for k, v in GREEK_LATIN.items()}

_SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
_FORCED_CYRILLIC = "бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯёЁ"

_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_EMOJI = regex.compile(r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\ufe0f]")
_JOINING = regex.compile(r"[\p{Arabic}\p{Hebrew}\p{Syriac}\p{Thaana}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Mongolian}\p{Khmer}\p{Myanmar}\p{Tibetan}]")
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Variation_Selector}\u034F\u115F\u1160\u17B4\u17B5\u3164\uFFA0]")
_SPACE = re.compile(f"[{_SPACES}]")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Bopomofo}]")
_WIDE = regex.compile(r"[\uFF01-\uFF9F\u3000\uFE50-\uFE6B]")
_COMPATIBLE = regex.compile(r"[\u2160-\u217F\uFB00-\uFB06\uFF61-\uFF9F\uF900-\uFAFF]")
_LETTER = regex.compile(r"\p{L}")
_CYRILLIC = regex.compile(r"\p{Cyrillic}")
_ALPHABETS = regex.compile(r"[\p{Greek}\p{Armenian}]")
_JAMO = regex.compile(r"[\u1100-\u11FF]")
STYLED, SMALL_CAPITALS, SIGNS = styled_letters(), small_capitals(), compatible_signs()
_STYLED_RUN = regex.compile("[" + "".join(STYLED) + r"]")
_SMALL = re.compile("[" + "".join(SMALL_CAPITALS) + "]")
_SIGN = re.compile("[" + "".join(map(re.escape, SIGNS)) + "]")
_GREEK_SIGN = regex.compile(r"\s*[=<>≤≥≈±×+*/^°]")


def _without_invisible(text: str) -> str:
    """Drop characters that show nothing, unless the script or an emoji needs them."""
    if not _INVISIBLE.search(text):
        return text
    joining = _JOINING.search(text) is not None
    out: list[str] = []
    for i, ch in enumerate(text):
        if not _INVISIBLE.match(ch):
            out.append(ch)
        elif ch == "\u200d":
            if joining or (out and _EMOJI.match(out[-1]) and i + 1 < len(text) and _EMOJI.match(text[i + 1])):
                out.append(ch)
        elif "\ufe00" <= ch <= "\ufe0f":
            if out and not out[-1].isalnum() and not out[-1].isspace():
                out.append(ch)
        elif joining and (ch in "\u200c\u200e\u200f\u061c" or "\u202a" <= ch <= "\u202e" or "\u2066" <= ch <= "\u2069"):
            out.append(ch)
        elif "\U000e0020" <= ch <= "\U000e007f" and out and (ord(out[-1]) == 0x1F3F4 or out[-1] >= "\U000e0020"):
            out.append(ch)
    return "".join(out)


def _plain_width(text: str) -> str:
    """Full-width forms become plain ones, except beside letters of a script that uses them."""
    if not _WIDE.search(text):
        return text
    if not _CJK.search(text):
        return "".join(unicodedata.normalize("NFKC", c) if _WIDE.match(c) else c for c in text)
    out = []
    for i, ch in enumerate(text):
        if not _WIDE.match(ch):
            out.append(ch)
            continue
        near = next((c for c in reversed(text[:i]) if c.isalpha() and not _WIDE.match(c)), None) or next((c for c in text[i + 1 :] if c.isalpha() and not _WIDE.match(c)), None)
        kana = "｡" <= ch <= "ﾟ"
        out.append(ch if near is None or (_CJK.match(near) and not kana) else unicodedata.normalize("NFKC", ch))
    return "".join(out)


def _script(ch: str) -> str | None:
    """L, C, G or A for the letters that have look-alikes, O for other letters, None for marks."""
    if ch < "ɐ" or "Ḁ" <= ch <= "ỿ" or "ɐ" <= ch <= "ʯ":
        return "L" if ch.isalpha() else None
    if "Ѐ" <= ch <= "ԯ":
        return "C" if ch.isalpha() else None
    if "Ͱ" <= ch <= "Ͽ" or "ἀ" <= ch <= "῿":
        return "G" if ch.isalpha() else None
    if "԰" <= ch <= "֏":
        return "A" if ch.isalpha() else None
    return "O" if ch.isalpha() else None


_TO = {
    "L": {**CYRILLIC_LATIN, **GREEK_LATIN, **ARMENIAN_LATIN},
    "C": {k: v for k, v in LATIN_CYRILLIC.items()},
    "G": {k: v for k, v in LATIN_GREEK.items()},
}


def _base(ch: str) -> str:
    return unicodedata.normalize("NFD", ch)[0]


def _plain_style(text: str) -> str:
    """Words in the letters of another font, or in small capitals, in plain letters.

    A single letter of another font is a sign (a variable, a set). Small capitals
    of the phonetic alphabet alone are phonetic letters.
    """

    if not _STYLED_RUN.search(text) and not _SMALL.search(text):
        return text

    def plain(m) -> str:
        token = m.group()
        if len(token) > 1 and _STYLED_RUN.search(token):
            token = "".join(STYLED.get(c, c) for c in token)
        if len(token) > 1 and any(c in SMALL_CAPITALS and c > "\u02ff" for c in token) and all(c.isascii() or c in SMALL_CAPITALS for c in token):
            token = "".join(SMALL_CAPITALS.get(c, c) for c in token)
        return token

    return _TOKEN.sub(plain, text)


def _plain_latin(text: str) -> str:
    """Latin letters that look like others, in the plain ones; phonetic letters stay in phonetic spelling."""
    if any(c in LATIN_LATIN for c in text):
        nordic = re.search("[þÞð]", text) is not None  # there Ð is a letter of its own
        phonetic = re.search("[əɪʃʊɛɔʒˈː]", text) is not None  # there ɡ, ɑ and ɩ are
        stay = "ß" + ("Ð" if nordic else "") + ("ɡɑɩ" if phonetic else "")
        return "".join(c if c in stay else LATIN_LATIN.get(c, c) for c in text)
    return text


class Spelling:
    """Consistent spellings by the fixed tables and ``extra``: letters of other alphabets and the Latin
    letters that they look like (:func:`confusables.look_alikes`)."""

    def __init__(self, extra: dict[str, str] | None = None, odd: frozenset[str] | None = None):
        self.extra = {k: v for k, v in (extra or {}).items() if k not in _TO["L"]}
        self.to = {**_TO, "L": {**self.extra, **_TO["L"]}}
        self._odd = odd
        self._sets: dict[str, tuple[str, str]] = {}

    def __reduce__(self):
        return Spelling, (self.extra, self.odd)

    @property
    def odd(self) -> frozenset[str]:
        """All characters for which :meth:`canonical` may change a text; all Cyrillic is among them."""
        if self._odd is None:
            every = "".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE1000))))
            kinds = (r"\p{M}", _CYRILLIC.pattern, _ALPHABETS.pattern, _JAMO.pattern, _INVISIBLE.pattern, _SPACE.pattern, _WIDE.pattern, _COMPATIBLE.pattern)
            listed = {*self.extra, *STYLED, *SMALL_CAPITALS, *SIGNS, *LATIN_LATIN, *"\u2010\u2011"}
            self._odd = frozenset({*regex.findall("|".join(kinds), every), *listed, *(c for c in every if not unicodedata.is_normalized("NFC", c))})
        return self._odd

    def script(self, ch: str) -> str | None:
        """As :func:`_script`; X for letters of still other alphabets that have a look-alike."""
        s = _script(ch)
        return "X" if s == "O" and ch in self.extra else s

    def resolved(self, token: str) -> tuple[str, str]:
        """(scripts the letters are of, scripts in which the whole token can be spelled)."""
        found = self._sets.get(token)
        if found is None:
            if len(self._sets) >= 1 << 16:
                self._sets.clear()
            own, can = set(), {"L", "C", "G", "A", "X", "O"}
            for ch in token:
                s = self.script(ch)
                if s is None:
                    continue
                own.add(s)
                here = {s}
                for t, table in self.to.items():
                    if ch in table or (t == "L" and s in "CG" and _base(ch) in table and _base(ch) != ch):
                        here.add(t)
                can &= here
            found = self._sets[token] = "".join(sorted(own)), "".join(sorted(can))
        return found

    def spell(self, token: str, script: str) -> str:
        table = self.to.get(script, {})
        out = []
        for ch in token:
            if ch in table and self.script(ch) != script:
                out.append(table[ch])
            elif script == "L" and self.script(ch) in ("C", "G") and _base(ch) in table:
                out.append(unicodedata.normalize("NFC", table[_base(ch)] + unicodedata.normalize("NFD", ch)[1:]))
            else:
                out.append(ch)
        return "".join(out)

    def one_script(self, text: str, context: str | None) -> str:
        """Choose for each token the spelling that is consistent with the token and its neighbours."""
        spans = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)]
        sets = [self.resolved(t) for _, _, t in spans]
        forced = [can if len(can) == 1 and can != "O" else "" for _, can in sets]
        votes = {s: sum(len(t) for (_, _, t), f in zip(spans, forced) if f == s) for s in "LCG"}
        if not any(votes.values()) and context:
            for t in _TOKEN.findall(context):
                can = self.resolved(t)[1]
                if can in votes:
                    votes[can] += len(t)
        main = max("LCG", key=lambda s: votes[s]) if any(votes.values()) else ""
        out, last = [], 0
        for i, (a, b, token) in enumerate(spans):
            own, can = sets[i]
            want = ""
            if len(own) > 1 and can:  # mixed scripts in one token
                want = can if len(can) == 1 else main if main and main in can else can[0] if "L" not in can else "L"
            elif own in ("C", "G", "L") and len(can) > 1:  # the whole token has look-alikes
                near = [f for f in (next((f for f in reversed(forced[:i]) if f), ""), next((f for f in forced[i + 1 :] if f), "")) if f]
                if own == "L":
                    # A Latin word in other text stays, unless all about it is of the other script.
                    other = main if main in can and main != "L" else ""
                    want = other if other and near and all(f == other for f in near) and votes["L"] == 0 else ""
                elif any(c in NOT_RUSSIAN for c in token) and "L" in can and votes["L"] >= votes[own]:
                    want = "L"
                elif own == "G" and len(token) == 1 and _GREEK_SIGN.match(text, b):
                    want = ""
                elif "L" in can and main == "L" and not (near and all(f == own for f in near)):
                    # Between two words of its own script it may be part of a quotation.
                    want = "L"
            out.append(text[last:a])
            out.append(self.spell(token, want) if want and own != want else token)
            last = b
        out.append(text[last:])
        return "".join(out)


    def canonical(self, text: str | None, context: str | None = None) -> str | None:
        """The consistent spelling of ``text``; ``context`` is another text of the same row.

        Null stays null. A text without letters is returned unchanged. The result of
        the result is the result.
        """
        if text is None or text.isascii() or self.odd.isdisjoint(text) or not _LETTER.search(text):
            return text
        t = _without_invisible(text)
        t = unicodedata.normalize("NFC", t)
        if _COMPATIBLE.search(t):
            t = unicodedata.normalize("NFC", _COMPATIBLE.sub(lambda m: unicodedata.normalize("NFKC", m.group()), t))
        t = unicodedata.normalize("NFC", _plain_width(t))
        t = _SPACE.sub(lambda m: m.group() if m.group() == "\u3000" and _CJK.search(t) and _wide_space_fits(t, m.start()) else " ", t)
        t = _SIGN.sub(lambda m: SIGNS[m.group()], t.replace("\u2010", "-").replace("\u2011", "-"))
        passed: set[str] = set()
        while not t.isascii() and t not in passed:  # a word that is decided may decide its neighbours
            passed.add(t)
            t = unicodedata.normalize("NFC", self.one_script(_plain_style(_plain_latin(t)), context))
        return unicodedata.normalize("NFC", t)


BASIC = Spelling()
canonical, resolved = BASIC.canonical, BASIC.resolved


def _wide_space_fits(text: str, at: int) -> bool:
    near = [c for c in (text[at - 1 : at], text[at + 1 : at + 2]) if c]
    return all(_CJK.match(c) or unicodedata.east_asian_width(c) in "WF" for c in near)


@lru_cache(maxsize=1)
def _shared(context) -> tuple[Broadcast, str]:
    """(spelling, JVM pattern of the characters that it acts on) of a Spark context: some thousand letters."""
    from pyspark.sql import SparkSession

    spelling = Spelling(look_alikes(SparkSession.active()))
    return context.broadcast(spelling), odd_pattern(spelling)


def odd_pattern(spelling: Spelling, shortest: int = 8) -> str:
    """Java pattern of the characters, but for Cyrillic, that ``spelling`` acts on, and some others.

    It names the runs of at least ``shortest`` characters that can be passed over.
    Java asks all runs of a class for each character, so those of much text are
    asked before.
    """
    runs, start = [], 0
    for c in [*sorted(ord(x) for x in spelling.odd if not _CYRILLIC.match(x)), 0x110000]:
        if c - start >= shortest:
            runs.append((start, c - 1))
        start = c + 1
    names = lambda rs: "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in rs)
    often = [r for r in runs if any(r[0] <= ord(c) <= r[1] for c in "aéđạあ漢가а")]
    return f"(?=[^{names(often)}])[^{names(runs)}]"


def suspicious(text: Column, context: Column, pattern: str) -> Column:
    """JVM test: may the canonical spelling differ?

    Cyrillic alone is a case only beside Latin letters, in the text or where a text
    without decisive letters asks its context, or with letters that Russian lacks.
    """
    cyrillic = text.rlike(r"\p{IsCyrillic}") & (text.rlike(r"\p{IsLatin}") | ~text.rlike(f"[{_FORCED_CYRILLIC}]") | text.rlike(f"[{''.join(sorted(NOT_RUSSIAN))}]"))
    return (F.octet_length(text) != F.length(text)) & (text.rlike(pattern) | cyrillic)


def _texts(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """One row for each text: (id, field_name, text, context)."""
    other = {f: next((o for o in fields if o != f), f) for f in fields}
    entries = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text"), F.col(other[f]).alias("context")) for f in fields])
    return df.select(F.col(id_col), F.explode(entries).alias("e")).select(id_col, "e.field_name", "e.text", "e.context")


def changed_texts(df: DataFrame, id_col: str = "row_index", fields: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    """(id, field_name, canonical) of each text whose consistent spelling differs.

    Null and empty texts, and texts without letters, are never cases. Repeated
    rows give a row each. Other columns are not read, so they cannot clash.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared, pattern = _shared(df.sparkSession.sparkContext)
    found = _texts(df, id_col, list(fields)).where(suspicious(F.col("text"), F.col("context"), pattern))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical = shared.value.canonical
        for pdf in batches:
            new = [canonical(t, c) for t, c in zip(pdf["text"], pdf["context"])]
            keep = [n != t for n, t in zip(new, pdf["text"])]
            out = pdf.loc[keep, [id_col, "field_name"]]
            yield out.assign(canonical=pd.Series([n for n, k in zip(new, keep) if k], index=out.index, dtype=object))

    return found.mapInPandas(run, f"`{id_col}` {kind}, field_name string, canonical string")


def canonical_columns(df: DataFrame, fields: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    """``df`` with each of ``fields`` in its consistent spelling; all rows and columns stay.

    Only suspicious texts are sent to Python; null stays null.
    """
    fields = tuple(fields)
    shared, pattern = _shared(df.sparkSession.sparkContext)
    fix = F.pandas_udf(lambda t, c: pd.Series([shared.value.canonical(x, y) for x, y in zip(t, c)], dtype=object), "string")
    new = {}
    for f in fields:
        text, context = F.col(f), F.col(next((o for o in fields if o != f), f))
        odd = suspicious(text, context, pattern)
        new[f] = F.when(odd, fix(F.when(odd, text), F.when(odd, context))).otherwise(text)
    return df.withColumns(new)
