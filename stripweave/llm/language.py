"""Language identification: words first, shorter and shorter n-grams for words never seen.

A word that the training rows know gets its log frequency in each language. An unseen
word is read from left to right, always by the longest n-gram (of up to ``order``
characters, word edges included) that the training rows know, and gets the mean of those
n-grams' log frequencies.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from xxhash import xxh64_intdigest

from .common import holds, map_texts

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: The most rows that the model is fitted on: those with the least hash of doc_id, the same at every run.
TRAINING_ROWS = 3_000
ORDER = 5
#: Words whose scores a worker remembers; with more it forgets them and begins anew.
WORD_CACHE = 120_000


def words_of(text: str) -> list[str]:
    """Runs of letters of any script, lower-cased; digits, other numbers (such as fractions), marks and underscores end a word."""
    found = WORD.findall(text.lower())
    if text.isascii():
        return found
    return [p for w in found for p in ((w,) if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def key_of(text: str) -> int:
    return xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class Frequencies:
    """Per-language log frequencies of strings, relative to the mean over the languages: sorted hashes, and a row for each."""

    def __init__(self, counts: dict[str, Counter], langs: list[str]) -> None:
        strings = list(set().union(*counts.values()))
        hashes = np.array([key_of(x) for x in strings], np.uint64)
        order = np.argsort(hashes)
        self.keys = array("Q", hashes[order].tobytes())
        table = np.array([[counts[k][strings[i]] for k in langs] for i in order.tolist()], float).reshape(len(strings), len(langs)) + 0.5
        table = np.log(table / np.array([sum(counts[k].values()) + 0.5 * len(strings) for k in langs]))
        self.rows = table - table.sum(axis=1, keepdims=True) / max(1, len(langs))

    def find(self, text: str) -> np.ndarray | None:
        key = key_of(text)
        at = bisect_left(self.keys, key)
        return self.rows[at] if at < len(self.keys) and self.keys[at] == key else None


class Model:
    """Frequencies of words and of n-grams. A language's share of the training rows isn't used: sources differ in it."""

    def __init__(self, rows: list[tuple[str, str]], *, order: int = ORDER) -> None:
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in rows:
            words[lang].update(words_of(text))
        self.langs, self.order = sorted(words), order
        self.words = Frequencies(words, self.langs)
        self.grams: list[Frequencies | None] = [None]
        for size in range(1, order + 1):
            grams: dict[str, Counter] = defaultdict(Counter)
            for lang, c in words.items():
                for w, n in c.items():
                    shown = f"^{w}$"
                    for i in range(len(shown) - size + 1):
                        grams[lang][shown[i : i + size]] += n
            self.grams.append(Frequencies(grams, self.langs))

    def scores(self, word: str) -> np.ndarray:
        known = self.words.find(word)
        return self.unseen(word) if known is None else known

    def unseen(self, word: str) -> np.ndarray:
        """Backoff over a word that isn't known: at each position the longest known n-gram.

        The next position is the last character read, so neighbouring n-grams overlap by one.
        The mean is taken over the n-grams used, so that an unseen word weighs as one word.
        """
        shown, at, total, used = f"^{word}$", 0, np.zeros(len(self.langs)), 0
        while at < len(shown):
            size = min(self.order, len(shown) - at)
            while size and (found := self.grams[size].find(shown[at : at + size])) is None:
                size -= 1
            if size:
                total += found
                used += 1
            at += max(1, size - 1)
        return total / max(1, used)


_CACHES: dict[int, Scorer] = {}
holds("language", _CACHES.clear)


class Scorer(dict):
    """Remembers where in a growing table each word's scores are."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.table = np.zeros((1024, len(model.langs)))

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        if i == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[i] = self.model.scores(word)
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the posterior over the learned languages.

        The posterior is tempered by the square root of the number of words, as words of a text
        aren't independent. A tie goes to the first language in alphabetical order.
        """
        words = words_of(text) if text else []
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        if len(self) > WORD_CACHE:  # between texts, so the table holds one text's words besides
            self.clear()
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        total = self.table[found].sum(axis=0) / math.sqrt(len(words))
        best = int(total.argmax())
        return self.model.langs[best], float(1.0 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def held_out():
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, *, rows: int = TRAINING_ROWS) -> Model:
    """Fit on the whole texts of at most ``rows`` labelled rows that aren't held out.

    They are those with the least hash, found first without their texts, so that no text is shuffled.
    Of rows that repeat the last id those with the least language and text are taken.
    """
    usable = docs.where(~held_out()).where("doc_id is not null and lang is not null and text is not null")
    slim = usable.select("lang", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("h"))
    last = slim.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    found = slim.where(F.col("h") <= last).orderBy("h", "lang", "text").limit(rows).collect() if last is not None else []
    return Model(sorted((r["lang"], r["text"]) for r in found))


def identify(docs: DataFrame, model: Model, *, keep: tuple[str, str] | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of each row, or its columns with the last two appended by the names in ``keep``.

    ``und`` with score 0 where the text is null, empty or has no letter, and wherever the model has
    learned no language (an empty table of labelled rows). Rows with null or repeated ``doc_id`` stay,
    each by itself; a null ``doc_id`` isn't held out. ``lang``, ``source`` and other columns aren't read here;
    the names in ``keep`` must be new ones. A text is read whole, whatever its length; equal texts have
    equal results, and a tie between languages goes to the first in alphabetical order.
    """
    # The model's size is bounded by the training bounds above; it goes out once with the task.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = id(shared.value)
        scorer = _CACHES.get(key)
        if scorer is None:
            _CACHES.clear()
            scorer = _CACHES[key] = Scorer(shared.value)
        found = [scorer.predict(t) for t in batch.column(texts).to_pylist()]
        langs, scores = pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, langs, scores], [*batch.schema.names, *(keep or ("lang_pred", "score"))])

    if keep:
        return map_texts(docs, run, StructType([*docs.schema.fields, StructField(keep[0], StringType()), StructField(keep[1], DoubleType())]), column=texts, name="language")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    texts = 2
    found = map_texts(slim, run, "doc_id long, held_out boolean, text string, lang_pred string, score double", column=2, name="language")
    return found.select("doc_id", "held_out", "lang_pred", "score")
