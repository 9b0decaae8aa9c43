"""Language identification by cross-parsing entropy against suffix automata of labelled text."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.common import free_names, query, read, text_hash

UNKNOWN = "und"
# The bounded labelled sample: of each language at most SAMPLE_DOCS distinct texts, SAMPLE_CHARS
# on end of each from a place that its hash picks, cut to REFERENCE characters of clean text,
# and less each with over 16 languages.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 400
# Rows whose id has a small md5 are drawn, about DRAWN for each text wanted; a language that
# they leave short draws WIDER times as many. The sample is the same for any numbers.
DRAWN, WIDER = 4, 8
REFERENCE = 24_000
ALL_REFERENCES = 16 * REFERENCE
# Long texts are parsed in pieces of this many characters; a phrase ends with its piece.
PIECE = 1_024
# An automaton with more cells (states by letters) than this is kept as a sorted list of its
# transitions, which is slower.
DENSE_CELLS = 8_000_000


class Model(NamedTuple):
    """languages, and of each the clean labelled text that its automaton is built from."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    kinds = (unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1))
    return np.fromiter(kinds, bool, sys.maxunicode + 1)


def code_points(text: str) -> np.ndarray:
    """Lower-case code points where each run of anything but letters is one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32)
    keep = letter | np.concatenate([[True], letter[:-1]]) if len(points) else letter
    return points[keep]


def _cut(share: float) -> str:
    """The text below which a share of all md5 sums lie, in hexadecimal digits."""
    return f"{int(share * 16**12):012x}" if share < 1.0 else "g"


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
        id_col: str = "doc_id") -> Model:
    """Collect the bounded sample of each language: the distinct texts with the smallest md5 of the id."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & (F.length(F.coalesce(text_col, F.lit(""))) > 0))
    h0, h1 = text_hash(F.col(text_col))
    # Equal texts have equal excerpts.
    start = F.pmod(h0, F.greatest(F.lit(1), F.length(text_col) - SAMPLE_CHARS + 1)).cast("int") + 1
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    counts = labelled.filter(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count()
    shares = {r["lang"]: min(1.0, DRAWN * SAMPLE_DOCS / r["count"]) for r in counts.collect()}
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("o", "text"))
    texts: dict[str, list[str]] = {}
    while shares:
        # Of a text, the copy with the smallest md5 decides, so a cut by md5 changes no ranks below it.
        cuts = F.create_map(*(F.lit(v) for lang, s in shares.items() for v in (lang, _cut(s))))
        drawn = rows.filter(order < cuts[F.col(lang_col)])
        drawn = drawn.select(F.col(lang_col).alias("lang"), h0.alias("h0"), h1.alias("h1"), order.alias("o"),
                             F.substring(F.col(text_col), start, F.lit(SAMPLE_CHARS)).alias("text"))
        drawn = drawn.groupBy("lang", "h0", "h1").agg(F.min(F.struct("o", "text")).alias("r"))
        drawn = drawn.select("lang", "r.o", "r.text")
        sample = drawn.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_DOCS)
        found: dict[str, list[str]] = {}
        for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["rank"])):
            found.setdefault(r["lang"], []).append(r["text"])
        full = {lang for lang, s in shares.items() if s == 1.0 or len(found.get(lang, ())) == SAMPLE_DOCS}
        texts.update((lang, found[lang]) for lang in full if lang in found)
        shares = {lang: min(1.0, s * WIDER) for lang, s in shares.items() if lang not in full}
    size = min(REFERENCE, ALL_REFERENCES // max(1, len(texts)))
    clean = {lang: "".join(map(chr, code_points(" ".join(t)).tolist()))[:size] for lang, t in texts.items()}
    clean = {lang: t for lang, t in sorted(clean.items()) if t.strip()}
    return Model(tuple(clean), tuple(clean.values()))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


class Automaton:
    """Steps of many texts at once through the automaton of one language.

    Symbols are those of its text: 0 is all that is not a letter, the last one every letter
    that the text lacks. Where no match goes on, a phrase ends and the symbol begins the
    next one; the start state, left at once, has no phrase to end.
    """

    def __init__(self, symbols: np.ndarray, count: int) -> None:
        own = np.unique(symbols[symbols > 0])
        self.width = width = len(own) + 2
        self.local = np.full(count, width - 1, np.int32)
        self.local[0] = 0
        self.local[own] = np.arange(1, width - 1)
        steps = suffix_automaton(self.local[symbols].tolist())
        dead = len(steps)  # behind a symbol that the language lacks
        self.again = np.full(width, dead, np.int64)
        self.again[list(steps[0])] = list(steps[0].values())
        if (dead + 1) * width <= DENSE_CELLS:
            table = np.full((dead + 1, width), -1, np.int64)
            for state, out in enumerate(steps):
                table[state, list(out)] = list(out.values())
            ended = table < 0
            table = np.where(ended, self.again, table)
            ended[0] = False
            # The lowest bit counts ends.
            self.table = (table * width << 1 | ended).astype(np.int32).ravel()
        else:
            self.table = None
            pairs = sorted((state * width + c, to) for state, out in enumerate(steps) for c, to in out.items())
            self.keys, self.targets = np.array(pairs, np.int64).T.copy()

    def step(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states times width, ends of phrases) behind states times width and local symbols."""
        if self.table is not None:
            went = self.table[state + symbols]
            return went >> 1, went & 1
        wanted = state + symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return np.where(found, self.targets[at], self.again[symbols]) * self.width, ~found & (state > 0)


class Parser:
    """Cross-parses many texts at once against all languages of a model.

    Every letter of the sample has a symbol; letters that no language has share one.
    """

    def __init__(self, model: Model) -> None:
        letters = sorted({ord(c) for text in model.texts for c in text} - {32})
        self.symbol = np.full(sys.maxunicode + 1, len(letters) + 1, np.int32)
        self.symbol[32] = 0
        self.symbol[letters] = np.arange(1, len(letters) + 1)
        self.lengths = np.array([len(t) for t in model.texts])
        self.automata = [Automaton(self.symbol[[ord(c) for c in t]], len(letters) + 2) for t in model.texts]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases, one row per text and one column per language."""
        pieces, owner = [], []
        for i, points in enumerate(texts):
            for at in range(0, len(points), PIECE):
                pieces.append(points[at:at + PIECE])
                owner.append(i)
        found = np.zeros((len(texts), len(self.automata)), np.int64)
        if not pieces:
            return found
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        lengths = np.array([len(pieces[i]) for i in order])
        grid = np.zeros((lengths[0], len(order)), np.int32)
        for column, i in enumerate(order):
            grid[:len(pieces[i]), column] = self.symbol[pieces[i]]
        # Texts are sorted by length, so those that still run are the first columns.
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        for lang, automaton in enumerate(self.automata):
            state = np.zeros(len(order), np.int64 if automaton.table is None else np.int32)
            count = np.ones(len(order), np.int32)  # the phrase that the end cuts off
            for at in range(lengths[0]):
                n = running[at]
                state[:n], ended = automaton.step(state[:n], automaton.local[grid[at, :n]])
                count[:n] += ended
            np.add.at(found[:, lang], np.array(owner)[order], count)
        return found

    def entropy(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per symbol: phrases times the bits that point into the reference, per length."""
        lengths = np.maximum(1, [len(t) for t in texts])[:, None]
        return self.phrases(texts) * np.log2(self.lengths + 1) / lengths


_parsers: dict[Model, Parser] = {}


def _parser(model: Model) -> Parser:
    """One parser per Python worker; the model itself is at most a few hundred kilobytes."""
    if model not in _parsers:
        _parsers.clear()
        _parsers[model] = Parser(model)
    return _parsers[model]


# Symbols parsed together.
BATCH = 1 << 20


def classify(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language of each text and a score from 0 to 1: how far the second language is behind."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return langs, scores
    parser, waiting, size = _parser(model), [], 0

    def flush() -> None:
        bits = parser.entropy([points for _, points in waiting])
        best = bits.argmin(axis=1)
        for (i, _), row, b in zip(waiting, bits, best, strict=True):
            rest = np.delete(row, b)
            langs[i] = model.languages[b]
            scores[i] = float(1 - row[b] / rest.min()) if len(rest) else 1.0

    for i, text in enumerate(texts):
        points = code_points(text or "")
        if (points != 32).any():
            waiting.append((i, points))
            size += len(points)
        if size >= BATCH:
            flush()
            waiting, size = [], 0
    if waiting:
        flush()
    return langs, scores


def predictor(model: Model):
    """A function from a text column to a struct (lang, score)."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in batches:
            langs, scores = classify(part.tolist(), model)
            yield pd.DataFrame({"lang": langs, "score": scores})

    return F.pandas_udf(predict, "lang string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Every third row by the crc32 of its id is never learnt from."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return crc % 3 == 1


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred and score to every row; columns of these names are replaced.

    The whole text is parsed greedily into the longest phrases that occur in a language's
    labelled text; the language with the fewest phrases, weighted by the bits that point
    into its text, wins, the first in code point order among equals. A null text, one
    without letters, and any text of a model without languages is ``und`` with score 0.
    """
    name, = free_names(docs, "_found")
    found = docs.withColumn(name, predictor(model)(F.col(text_col)))
    return found.withColumns({"lang_pred": F.col(name)["lang"], "score": F.col(name)["score"]}).drop(name)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = read(spark, sf, "documents")
    model = fit(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
