"""Problem 3: repetition inside one text.

The share of a text that says again what it has said before is measured by its
letters: case, spacing, punctuation and digits are left out first. A letter is
repeated if it lies in a stretch that occurred earlier in the same text (the
stretch may overlap its earlier occurrence), in a sentence whose letters are
those of an earlier sentence, or in the second and later turns of a loop of three
turns or more.

Which share is a case is decided by risk-controlled cutoffs. For each stratum
(field and writing) a labelled holdout is composed of sentences of the corpus:
some are put together as they are, some are planted again with edits, some form
lists of different things under one lead. Labels are counted from what was
planted and never ask the measure, so that the measure can fail on them. The
cutoff is the lowest share at which the exact binomial (Clopper-Pearson) bound on
the rate of false rejections stays under ``risk``. Cutoffs are tested in a fixed
sequence from strict to lenient down to one half, which is the definition; the
error probability is divided by all tests, those of the strata and the pooled one
that serves strata without a holdout (Bonferroni).

Every text is measured in Python. Words are no bound of the share: letters repeat
across spacing, inside words and in scripts without spaces.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pairloom.llm.sampling import lowest_hashes
from pairloom.storage import spread

_ENDS = ".!?…。！？\n\r;"
_SENTENCE = re.compile(f"[{_ENDS}]+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
#: Writing and a letter of it, in the order in which they are asked.
WRITINGS = [("cjk", r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]"), ("cyrillic", r"[\u0400-\u04ff]"), ("marked", "[\u1ea0-\u1ef9\u01a0\u01a1\u01af\u01b0\u0110\u0111]")]
#: Weight that a stretch must have. A letter weighs 1, one of a script that writes a word in one or two signs 2.
STRETCH = 16
_RUNS = [b"\x01" * max(2 * p, 4) for p in range(STRETCH)]


class _Letters(dict):
    """For ``str.translate``: letters and ends of sentences stay, all else goes."""

    def __missing__(self, code: int) -> str | None:
        ch = chr(code)
        self[code] = kept = ch if ch.isalpha() or ch in _ENDS else None
        return kept


_PLAIN = _Letters()


def sentences_of(text: str) -> list[str]:
    """The letters of each sentence that has some."""
    return [x for x in _SENTENCE.split(text.casefold().translate(_PLAIN)) if x]


def letters(text: str) -> str:
    return "".join(sentences_of(text))


def _stretches(part: str) -> list[str]:
    """The shortest stretch of enough weight from each letter on, as far as there is one."""
    if part.isascii() or not _CJK.search(part):
        return [part[i : i + STRETCH] for i in range(len(part) - STRETCH + 1)]
    weights = [2 if _CJK.match(c) else 1 for c in part]
    out, end, have = [], 0, 0
    for i, w in enumerate(weights):
        while have < STRETCH and end < len(part):
            have += weights[end]
            end += 1
        if have < STRETCH:
            break
        out.append(part[i:end])
        have -= w
    return out


def _mark_loops(whole: str, marks: bytearray) -> None:
    """Mark all but the first turn of loops of three turns or more, such as "ha ha ha".

    A turn is shorter than a stretch; longer ones are stretches that repeat.
    """
    n, most = len(whole), min(STRETCH, len(whole) // 3 + 1)
    code = whole.encode("utf-32-le") + bytes(4 * STRETCH)
    shifted = np.ndarray((most - 1, n), np.uint32, code, 4, (4, 4))  # row p - 1: each letter's p-th successor
    same = (shifted == np.ndarray((n,), np.uint32, code)).tobytes()
    for period in range(1, most):
        run, start, until = _RUNS[period], (period - 1) * n, period * n
        at = same.find(run, start, until)
        while at >= 0:
            end = same.find(0, at, until)
            end = until if end < 0 else end
            marks[at - start + period : end - start + period] = b"\x01" * (end - at)
            at = same.find(run, end, until)


def repeated_share(text: str | None) -> float:
    """Share of the letters of ``text`` that repeat what was said before, 0 to 1.

    Null, empty and letterless texts have share 0. Time and memory grow in
    proportion to the text's length; nothing depends on its size otherwise.
    """
    if not text:
        return 0.0
    parts = sentences_of(text)
    whole = "".join(parts)
    n = len(whole)
    if n < 4:
        return 0.0
    marks = bytearray(n)
    if len(set(parts)) < len(parts):
        seen: set[str] = set()
        at = 0
        for p in parts:
            if p in seen:
                marks[at : at + len(p)] = b"\x01" * len(p)
            seen.add(p)
            at += len(p)
    found = [_stretches(p) for p in parts]  # stretches do not run over the end of a sentence
    if sum(map(len, found)) > len(set().union(*found)):
        first: set[str] = set()
        start = 0
        for p, grams in zip(parts, found):
            until = start  # letters before this are already marked
            for i, gram in enumerate(grams, start):
                if gram in first:
                    a, until = max(i, until), i + len(gram)
                    marks[a:until] = b"\x01" * (until - a)
                else:
                    first.add(gram)
            start += len(p)
    _mark_loops(whole, marks)
    return marks.count(1) / n


def writing(text: Column) -> Column:
    """The stratum's writing: 'cjk', 'cyrillic', 'marked' (Latin with Vietnamese letters) or 'latin'."""
    return reduce(lambda other, w: F.when(text.rlike(w[1]), w[0]).otherwise(other), reversed(WRITINGS), F.lit("latin"))


def writing_of(text: str) -> str:
    """The same in Python."""
    for kind, pattern in WRITINGS:
        if re.search(pattern, text):
            return kind
    return "latin"


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly."""
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))


def certified_cutoff(scores: list[float], risk: float, error: float, grid: list[float]) -> float | None:
    """Lowest cutoff of ``grid`` (strict first) whose false rejections are certified to stay under ``risk``.

    ``scores`` are those of holdout texts that must not be rejected; a text is
    rejected if its score is above the cutoff. None: not even the first holds.
    """
    best = None
    for cut in grid:
        wrong = sum(s > cut for s in scores)
        if not scores or binomial_tail(wrong, len(scores), risk) > error:
            break
        best = cut
    return best


def rate_bound(wrong: int, n: int, error: float) -> float:
    """Upper Clopper-Pearson bound of a rate of which ``wrong`` of ``n`` were seen; 1 without any."""
    low, high = (wrong / n if n else 1.0), 1.0
    while high - low > 1e-6:
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(wrong, n, middle) > error else (low, middle)
    return high


@dataclass(frozen=True)
class Cutoffs:
    """Share above which a text is a case, by (field, writing); ``default`` is for strata without a holdout.

    ``certificates``: (stratum, negatives, rejected, bound of the rate, cutoff) of each test.
    """

    by_stratum: dict[tuple[str, str], float]
    default: float
    certificates: tuple[tuple[str, int, int, float, float], ...] = ()

    def column(self, field: Column, kind: Column) -> Column:
        out = F.lit(self.default)
        for (f, w), cut in sorted(self.by_stratum.items()):
            out = F.when((field == f) & (kind == w), F.lit(cut)).otherwise(out)
        return out


def _edited(rnd: random.Random, sentence: str, style: int, place: int) -> str:
    """The sentence again with other case, punctuation, spacing or number."""
    if style == 1:
        return f"{place}. {sentence}"
    if style == 2:
        return sentence.upper() if place % 2 else sentence
    if style == 3:
        return sentence.rstrip(".!?。") + rnd.choice("!.?")
    if style == 4:
        at = rnd.randrange(len(sentence))
        return sentence[:at] + " " + sentence[at:]
    return sentence


def holdout(sentences: list[str], size: int, seed: int) -> list[tuple[str, bool]]:
    """(text, is mostly repetition) composed of different sentences with planted repetition.

    Three quarters are no repetition: different sentences, up to a third said again
    with edits, or a list of different things that begin alike. A label is
    counted from the letters that were planted again; sentences that resemble
    each other are not sorted out.
    """
    rnd = random.Random(seed)
    out = []
    for i in range(size):
        few = rnd.sample(sentences, min(len(sentences), rnd.randint(2, 8)))
        style = rnd.randrange(5)
        if i % 4 == 0:  # repetition of more than half
            body = [few[0]] * rnd.randint(3, 8) + [s for s in few[1:2] if 2 * len(letters(s)) <= len(letters(few[0]))]
        elif i % 4 == 1:
            body = few
        elif i % 4 == 2:  # up to a third is said again
            body, more, room = few, [], 0.5 * sum(len(letters(s)) for s in few)
            for s in few:
                if len(letters(s)) <= room:
                    more.append(s)
                    room -= len(letters(s))
            body = few + more if style % 2 else [x for s in few for x in [s] * (1 + (s in more))]
        else:  # a list of different things
            lead, *tails = (" ".join(s.split()[:2] if k == 0 else s.split()[-4:]) if " " in s else s[:4] if k == 0 else s[-8:] for k, s in enumerate(few))
            tails = list({letters(x): x for x in tails}.values())
            again = len(letters(lead)) * (len(tails) - 1)
            items = [f"{lead} {x}" for x in tails] if 3 * again <= sum(len(letters(x)) for x in tails) + again + len(letters(lead)) else tails
            out.append(("\n".join(f"{j}. {x}" for j, x in enumerate(items, 1)) if style % 2 else "; ".join(items), False))
            continue
        sizes = [len(letters(s)) for s in body]
        fresh = sum({letters(s): n for s, n in zip(body, sizes)}.values())
        shown = [_edited(rnd, s, style, j) for j, s in enumerate(body, 1)]
        out.append((("\n" if style == 1 else " ").join(shown), 2 * (sum(sizes) - fresh) > sum(sizes)))
    return out


def is_material(sentence: str, cjk: bool) -> bool:
    """Enough letters, and most groups of three (in scripts without spaces two) neighbouring ones different:
    no loop. The measure is not asked."""
    plain, k = letters(sentence), 2 if cjk else 3
    groups = [plain[i : i + k] for i in range(len(plain) - k + 1)]
    return len(plain) >= (8 if cjk else 18) and len(set(groups)) >= 0.7 * len(groups)


def texts_of(df: DataFrame, id_col: str, answer: str, metadata: str, entry: str) -> DataFrame:
    """(id, field_name, text): the answer and an entry of the metadata map of each row."""
    return df.select(
        F.col(id_col),
        F.explode(F.array(F.struct(F.lit("answer").alias("field_name"), F.col(answer).alias("text")), F.struct(F.lit("metadata").alias("field_name"), F.element_at(F.col(metadata), entry).alias("text")))).alias("e"),
    ).select(id_col, "e.field_name", "e.text")


def fit_cutoffs(df: DataFrame, id_col: str, answer: str, metadata: str, entry: str, risk: float = 0.01, error: float = 0.05, rows: int = 2500, size: int = 2000, seed: int = 7) -> Cutoffs:
    """Cutoffs from labelled holdouts.

    The sentences come from at most ``rows`` rows, those of lowest hash, whatever
    the size of the corpus; each stratum of eight sentences or more gets ``size``
    composed texts. The pooled holdouts decide for the others, as a test of its
    own. A holdout that fails at each cutoff gives the strictest one; where there is
    too little to certify anything, the definition's one half holds and the
    certificate shows a bound above ``risk``.
    """
    few = lowest_hashes(df.select(F.col(id_col), F.col(answer).alias("answer"), F.element_at(F.col(metadata), entry).alias("metadata")), rows, seed, F.col(id_col))
    sample = [Row(field_name=f, kind=writing_of(r[f]), text=r[f]) for r in few for f in ("answer", "metadata") if r[f]]
    pools: dict[tuple[str, str], dict[str, str]] = {}
    for r in sample:
        pool = pools.setdefault((r.field_name, r.kind), {})
        for s in re.findall(r"[^.!?…。！？\n\r;]+[.!?…。！？;]*", r.text):
            if is_material(s, r.kind == "cjk"):
                pool.setdefault(letters(s), s.strip())
    ready = {k: list(v.values()) for k, v in sorted(pools.items()) if len(v) >= 8}
    grid = [c / 100 for c in range(95, 49, -1)]
    share_of_error = error / (len(ready) + 1)
    scores = {k: [repeated_share(t) for t, much in holdout(sentences, size, seed + i) if not much] for i, (k, sentences) in enumerate(ready.items())}
    tests = {**scores, ("pooled", "all"): [x for v in scores.values() for x in v]}
    cutoffs, certificates = {}, []
    for k, values in tests.items():
        cut = certified_cutoff(values, risk, share_of_error, grid)
        enough = binomial_tail(0, len(values), risk) <= share_of_error
        cutoffs[k] = cut if cut is not None else grid[0] if enough else grid[-1]
        wrong = sum(x > cutoffs[k] for x in values)
        certificates.append(("/".join(k), len(values), wrong, rate_bound(wrong, len(values), share_of_error), cutoffs[k]))
    return Cutoffs({k: c for k, c in cutoffs.items() if k in ready}, cutoffs["pooled", "all"], tuple(certificates))


def repetition(df: DataFrame, id_col: str = "row_index", answer: str = "answer", metadata: str = "metadata", entry: str = "model_reasoning", cutoffs: Cutoffs | None = None) -> DataFrame:
    """(id, field_name, share, cutoff) of each text that is mostly repetition.

    Null, empty and letterless texts are no cases. Texts are measured whole.
    Repeated rows give a row each; other columns are not read.
    """
    texts = texts_of(spread(df.select(id_col, answer, metadata)), id_col, answer, metadata, entry).where("text is not null")
    cutoffs = cutoffs or fit_cutoffs(df, id_col, answer, metadata, entry)
    measured = texts.withColumn("cutoff", cutoffs.column(F.col("field_name"), writing(F.col("text"))))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            share = pdf["text"].map(repeated_share).astype("float64")
            yield pdf.assign(share=share)[share > pdf["cutoff"]][[id_col, "field_name", "share", "cutoff"]]

    return measured.mapInPandas(run, f"`{id_col}` {kind}, field_name string, share double, cutoff double")
