"""Language ID: words first, then shorter and shorter character n-grams.

A known word scores its log frequency in each language.  An unseen word falls back to its
character 4-grams (the word in boundary marks); where none of them is known, to 3-grams,
and so on to single characters.  A text's score in a language is the mean over its words;
the confidence is the softmax of that mean over the languages, sharpened by the number of
words up to ``SHARP_WORDS``.

The fit uses a bounded sample of the labelled rows: about ``SAMPLE_DOCS`` documents of
each language, picked by a hash of their id; every word of their whole texts is kept, and
every n-gram of these.  Prediction covers every whole text and sees nothing else of a row.

Defined results: a text that is null or has no letter is ``und`` with score 0; ties go to
the first language by name; nothing learned means ``und`` for all; rows with a null
language or id teach nothing; a column of more than ``MOST_LANGUAGES`` languages is refused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
SAMPLE_DOCS = 1_500
MOST_LANGUAGES = 500
LONGEST_GRAM = 4
SMOOTH = 0.5
SHARP_WORDS = 30
MIN_SCORE = 0.5
RATE_STEPS = 1_000_000
# Words whose scores one worker keeps.
CACHE_WORDS = 300_000

_WORDS = re.compile(r"[^\W\d_]+").findall


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    words: dict[str, dict[str, int]]          # language -> word -> count

    def scorer(self):
        return _Scorer(self)


def grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i:i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


class _LogTable:
    """Log frequencies of words or n-grams in each language: a row number for each, and one matrix."""

    def __init__(self, counts: list[Counter]):
        names = sorted(set().union(*counts))
        self.at = {name: i for i, name in enumerate(names)}
        table = np.zeros((len(names), len(counts)))
        for j, of in enumerate(counts):
            for name, n in of.items():
                table[self.at[name], j] = n
        self.logs = np.log((table + SMOOTH) / (table.sum(0) + SMOOTH * max(1, len(table))))

    def get(self, name: str) -> np.ndarray | None:
        i = self.at.get(name)
        return None if i is None else self.logs[i]


class _Scorer:
    def __init__(self, model: LanguageModel):
        self.langs = model.languages
        per_lang = [model.words[lang] for lang in self.langs]
        self.words = _LogTable(per_lang)
        self.tables = []
        for size in range(1, LONGEST_GRAM + 1):
            counts: list[Counter] = [Counter() for _ in self.langs]
            for of, words in zip(counts, per_lang, strict=True):
                for word, n in words.items():
                    for g in grams(word, size):
                        of[g] += n
            self.tables.append(_LogTable(counts))
        self.forget()

    def forget(self) -> None:
        """Drop the scores kept of words seen so far."""
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.langs)))

    def word(self, word: str) -> np.ndarray:
        """Log frequency in each language, of the word or of its longest known n-grams."""
        known = self.words.get(word)
        if known is not None:
            return known
        for size in range(LONGEST_GRAM, 0, -1):
            table = self.tables[size - 1]
            found = [i for i in map(table.at.get, grams(word, size)) if i is not None]
            if found:
                return table.logs[found].mean(0)
        return np.zeros(len(self.langs))            # no character of it was ever seen

    def _total(self, words: list[str]) -> np.ndarray:
        """Sum of the words' scores."""
        rows = list(map(self.rows.get, words))
        if None in rows:
            if len(self.rows) > CACHE_WORDS:
                self.rows.clear()
            for w in words:
                if w not in self.rows:
                    at = self.rows[w] = len(self.rows)
                    if at >= len(self.scores):
                        self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                    self.scores[at] = self.word(w)
            rows = list(map(self.rows.get, words))
        return self.scores[rows].sum(0)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORDS((text or "").lower())
        if not all(map(str.isalpha, words)):        # other numerals beside the decimal digits
            words = [p for w in words for p in "".join(c if c.isalpha() else " " for c in w).split()]
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        # In blocks, so that a very long text can't outgrow the cache of words.
        total = sum(self._total(words[a:a + 50_000]) for a in range(0, len(words), 50_000))
        mean = total / len(words)
        odds = np.exp((mean - mean.max()) * min(len(words), SHARP_WORDS))
        best = int(np.argmax(mean))
        return self.langs[best], float(odds[best] / odds.sum())


def fit_languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  learn: Column | None = None, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Fit on the documents with a language for which ``learn`` (a condition on the id) holds."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                      F.col(f"`{text_col}`").alias("text")).where("id is not null and lang is not null")
    if learn is not None:
        src = src.where(learn)
    counts = {r.lang: r.n for r in src.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} languages")
    if not counts:
        return LanguageModel((), {})
    rate = F.lit(0)
    for lang, n in sorted(counts.items()):
        rate = F.when(F.col("lang") == lang, min(RATE_STEPS, max(1, round(RATE_STEPS * sample_docs / n)))).otherwise(rate)
    words = (src.where(F.pmod(F.xxhash64("id", F.lit(37)), F.lit(RATE_STEPS)) < rate)
             .select("lang", F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("word")).where("word != ''")
             .groupBy("lang", "word").agg(F.count("*").alias("n")))
    table: dict[str, dict[str, int]] = {lang: {} for lang in counts}
    for r in words.collect():                       # the distinct words of the sample
        table[r.lang][r.word] = r.n
    return LanguageModel(tuple(sorted(table)), table)


def _scored(docs: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    """Columns c0, c1, ... of ``docs``, then ``lang_pred`` and ``score``; numbered, so that no name clashes."""
    src = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"
    # Tables of the words and n-grams of SAMPLE_DOCS documents a language, made once.
    shared = docs.sparkSession.sparkContext.broadcast(model.scorer())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from loadsmith.llm._tokens import release_memory

        scorer = shared.value
        for batch in batches:
            made = [scorer.predict(v.as_py()) for v in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m[0] for m in made], pa.string()),
                                              pa.array([m[1] for m in made], pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])
        scorer.forget()
        release_memory()

    unset = [F.lit(None).cast(t).alias(n) for n, t in (("lang_pred", "string"), ("score", "double"))]
    return src.mapInArrow(run, src.select("*", *unset).schema)


def predict_languages(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    out = _scored(docs.select(id_col, text_col), model, text_col)
    return out.select(F.col("c0").alias(id_col), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel, *, text_col: str = "text",
                    min_score: float = MIN_SCORE) -> DataFrame:
    """``docs``, all columns, without the undetermined and those scored below ``min_score``."""
    out = _scored(docs, model, text_col).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
