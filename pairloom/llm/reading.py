"""Problem 7: the reading level of each document.

A familiar-word formula: one scale, the sum of the share of words that are not
familiar and of the mean length of sentences, each with its weight, and cut points
between the bands. Familiar are the frequent words of the documents themselves, by
the number of documents that have them. Nested lists of several lengths grade how
familiar a word is; their weights, that of the sentence length and the cut points
are fitted to passages of known level, so the formula needs no list or weights
from elsewhere.

Document frequencies are aggregated before the shuffle (a word once for each
task); only the longest list, a fixed number of words, is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.storage import spread

#: Lengths of the nested lists of frequent words.
LISTS = (25, 50, 75, 100, 150, 200, 300, 400, 500, 600)
#: Least number of words that a document must have to be given a band.
LEAST_WORDS = 60
#: Ridge of the least squares, in squared shares: the lists overlap.
RIDGE = 1e-5
#: At most so many graded passages are used for fitting.
MOST_GRADED = 10_000

# English function words that the other languages of the tables do not share.
ENGLISH = "the of and is to it was we for that with not be this from by are you they have has at she which their".split()
_WORD = re.compile(r"[a-z]+(?:'[a-z]+)?")
_SENTENCE = re.compile(r"[.!?]+[\"”’')]?(?=\s|$)")
_LETTERED = re.compile(r"[^\W\d_]\S*")
_MARKUP = [(re.compile(r"</?[A-Za-z!][^<>]*>"), " "), (re.compile(r"https?://\S+"), " "), (re.compile(r"&amp;"), " and "), (re.compile(r"&(?:nbsp|lt|gt|quot|#\d+);"), " ")]


def clean(text: str) -> str:
    """Text without tags, addresses and written-out entities."""
    if "<" in text or "&" in text or "http" in text:
        for pattern, by in _MARKUP:
            text = pattern.sub(by, text)
    return text


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def sentences(text: str) -> int:
    """Number of sentences, 1 at least."""
    return max(1, len(_SENTENCE.findall(text)))


def running_words(text: str) -> int:
    """Words between white space that have a letter."""
    return len(_LETTERED.findall(text))


def english(counts: Counter, total: int, text: str) -> bool:
    """Is the text English: enough of its words are English function words, and its letters are plain ones.

    What the table says of the language is not asked.
    """
    if sum(counts[w] for w in ENGLISH) < 0.08 * total:
        return False
    if text.isascii():
        return True
    letters = sum(map(str.isalpha, text))
    return sum(c.isalpha() and c.isascii() for c in text) >= 0.9 * letters


def prose(text: str, told: bool) -> tuple[Counter, int, bool]:
    """(words and how often, running words, is it English prose of enough words) of a cleaned text."""
    counts = Counter(words(text))
    n = running_words(text)
    return counts, n, bool(told and n >= LEAST_WORDS and english(counts, counts.total(), text))


def frequent_words(texts: DataFrame, most: int = max(LISTS), flush: int = 1_000_000) -> list[str]:
    """The ``most`` words that most prose texts have, over all rows (text, told).

    Each task counts its documents' words first and gives a word once, or more
    often where it meets more than ``flush`` different words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df: Counter = Counter()
        for pdf in batches:
            for t, told in zip(pdf["text"], pdf["told"]):
                counts, _, good = prose(clean(t), told)
                if good:
                    df.update(counts.keys())
            if len(df) > flush:
                yield pd.DataFrame({"w": list(df.keys()), "n": list(df.values())})
                df = Counter()
        if df:
            yield pd.DataFrame({"w": list(df.keys()), "n": list(df.values())})

    counted = texts.mapInPandas(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    return [r.w for r in counted.orderBy(F.desc("n"), "w").limit(most).collect()]


def features(counts: Counter, n_sentences: int, rank: dict[str, int]) -> list[float]:
    """Shares of words outside each list, and the logarithm of the mean sentence length."""
    total = counts.total()
    r = np.fromiter((rank.get(w, 1 << 30) for w in counts), dtype=np.int64, count=len(counts))
    n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
    inside = np.bincount(np.searchsorted(_CUTS, r, side="right"), weights=n, minlength=len(LISTS) + 1).cumsum()
    return [*(1 - inside[:-1] / total), float(np.log(total / n_sentences))]


_CUTS = np.array(LISTS)


@dataclass(frozen=True)
class Formula:
    """``weights`` of the features and ``offset`` give the level; ``cuts`` part the ``bands`` on that scale."""

    bands: tuple[int, ...]
    weights: np.ndarray
    offset: float
    cuts: np.ndarray
    rank: dict[str, int]

    def level(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset

    def band(self, level: np.ndarray) -> np.ndarray:
        return np.array(self.bands)[np.searchsorted(self.cuts, level, side="left")]


def cut_between(levels: np.ndarray, higher: np.ndarray) -> float:
    """Middle of the widest gap that puts the fewest passages on the wrong side; ``higher`` are those of higher bands."""
    order = np.argsort(levels, kind="stable")
    levels, higher = levels[order], higher[order]
    gaps = np.diff(levels)
    if not (gaps > 0).any():
        return float(levels[0])
    wrong = np.where(gaps > 0, np.cumsum(higher)[:-1] + (~higher)[::-1].cumsum()[::-1][1:], len(levels) + 1)
    at = int(np.where(wrong == wrong.min(), gaps, -1).argmax())
    return float((levels[at] + levels[at + 1]) / 2)


def fit(graded: DataFrame, frequent: list[str], passage: str = "passage", band: str = "band") -> Formula | None:
    """Least squares on passages of known band, with a slight ridge, and cut points. None without passages."""
    rank = {w: i for i, w in enumerate(frequent)}
    rows = graded.where(F.col(passage).isNotNull() & F.col(band).isNotNull()).select(F.col(passage).alias("p"), F.col(band).alias("b")).limit(MOST_GRADED).collect()
    rows = [r for r in rows if words(r.p)]
    if not rows:
        return None
    x = np.array([features(Counter(words(clean(r.p))), sentences(clean(r.p)), rank) for r in rows])
    y = np.array([float(r.b) for r in rows])
    middle, mean = x.mean(0), y.mean()
    weights = np.linalg.solve((x - middle).T @ (x - middle) / len(x) + RIDGE * np.eye(x.shape[1]), (x - middle).T @ (y - mean) / len(x))
    bands = tuple(sorted({int(r.b) for r in rows}))
    level = x @ weights + mean - middle @ weights
    # Cut points rise with the bands, also where passages of two bands cannot be told apart.
    cuts = np.maximum.accumulate([cut_between(level, y > b) for b in bands[:-1]]) if len(bands) > 1 else np.array([])
    return Formula(bands, weights, float(mean - middle @ weights), cuts, rank)


def reading_levels(documents: DataFrame, graded: DataFrame, text: str = "text", id_col: str = "doc_id", kind: str | None = "kind") -> DataFrame:
    """(id, words, unfamiliar, mean_sentence, level, band, prose) of every row with a text.

    ``unfamiliar`` is the share of words outside the longest list but two,
    ``level`` the value of the formula, from the first to the last band, ``band`` the
    one between whose cut points it lies. ``prose``: English running text of at least 60 words, not of
    kind 'log'; only these are comparable with the graded passages. Null texts
    and texts without Latin words have no row. Rows of equal id give a row each.
    Without graded passages there is no level and the result is empty.
    """
    told = F.coalesce(F.lower(F.trim(F.col(kind))) != "log", F.lit(True)) if kind else F.lit(True)
    texts = spread(documents.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), told.alias("told"), F.col(text).alias("text")))
    formula = fit(graded, frequent_words(texts.select("told", "text")))
    schema = f"`{id_col}` {documents.schema[id_col].dataType.simpleString()}, words int, unfamiliar double, mean_sentence double, level double, band int, prose boolean"
    if formula is None:
        return documents.sparkSession.createDataFrame([], schema)
    shared = documents.sparkSession.sparkContext.broadcast(formula)
    middle = LISTS.index(LISTS[-3])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = shared.value
        for pdf in batches:
            rows, x = [], []
            for i, told_, t in zip(pdf["id"], pdf["told"], pdf["text"]):
                t = clean(t)
                counts, n, good = prose(t, told_)
                if counts:
                    rows.append((i, n, good))
                    x.append(features(counts, sentences(t), f.rank))
            if not rows:
                continue
            x = np.array(x)
            level = f.level(x)
            ids, n, good = zip(*rows)
            yield pd.DataFrame({id_col: list(ids), "words": n, "unfamiliar": x[:, middle], "mean_sentence": np.exp(x[:, -1]), "level": level.clip(f.bands[0], f.bands[-1]), "band": f.band(level), "prose": good})

    return texts.mapInPandas(run, schema)
