"""Language identification, words first.

A word that training knows is scored by its log frequency in each language.
An unseen word backs off to the n-grams of its characters (with marks for its
ends), the longest first: the first length of which training knows any gives
the word the mean log frequency of its known n-grams. A text has the language
of the largest sum; its score is that language's share after the sums are
scaled by the square root of the number of words.

``train`` fits the tables on a bounded sample of labelled rows
(``max_documents``, drawn by a hash of the id) and keeps every language of
the sample, and of its words and n-grams those of the largest share in any
language, ``max_words`` and ``max_grams`` at most. So the model's size is
bounded, whatever the corpus, and is broadcast. ``predict`` reads every text
whole.

Defined results: a text that is null or has no letter is ``und`` with score
0. A text none of whose letters training has seen gets the language of most
training words, with score 1 / languages; equal sums go to the alphabetically
first. If nothing was learned, every text is ``und``. Rows without a label or
text are not learned from. Extra columns are not read. ``keep_identified``
keeps every row whose text has a letter, whatever was learned, and puts the
predicted language into ``lang`` where that is null or the score ``CERTAIN``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import fold, fresh_name, quoted, release_memory, shared_value, written

UNDETERMINED = "und"
MAX_DOCUMENTS = 20_000
MAX_WORDS = 100_000
MAX_GRAMS = 60_000
LONGEST = 5
# Added to every count, in words of the language's training text.
SMOOTHING = 0.5
# Unseen words a task remembers; a full table is emptied.
CACHE_WORDS = 200_000
# Score from which a predicted language replaces a given one.
CERTAIN = 0.99
LETTERS = re.compile(r"[^\W\d_]+")
_WORD, _GRAM = "w", "g"


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _has_letter(words: list[str]) -> bool:
    """Whether the words, runs of letters or numerals, hold a letter: a run may
    be of numerals such as a superscript two."""
    return any(c.isalpha() for w in words for c in w)


def grams_of(word: str, size: int) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


@dataclass
class Model:
    """Languages, and the log frequencies of words and n-grams in each."""

    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    common: int             # the language of most training words

    def backoff(self, word: str) -> np.ndarray | None:
        """Scores of an unseen word; None if no n-gram of it is known."""
        for size in range(min(LONGEST, len(word) + 2), 0, -1):
            known = [self.grams[g] for g in grams_of(word, size) if g in self.grams and g != " "]
            if known:
                return self.gram_logs[known].mean(axis=0)
        return None


class Scorer:
    """Scores texts by a model; remembers unseen words, in bounded memory."""

    def __init__(self, model: Model):
        self.model = model
        self.unseen: dict[str, np.ndarray | None] = {}

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        model = self.model
        count = len(model.languages)
        if not count or not _has_letter(words):
            return UNDETERMINED, 0.0
        total, scored = np.zeros(count), 0
        known, times, unseen = [], [], self.unseen
        for word, n in Counter(words).items():
            at = model.words.get(word)
            if at is not None:
                known.append(at)
                times.append(n)
                continue
            if word in unseen:
                logs = unseen[word]
            else:
                if len(unseen) >= CACHE_WORDS:
                    unseen.clear()
                logs = unseen[word] = model.backoff(word)
            if logs is not None:
                total += n * logs
                scored += n
        if known:
            total += np.array(times, float) @ model.word_logs[known]
            scored += sum(times)
        if not scored:
            return model.languages[model.common], 1 / count
        best = int(np.argmax(total))
        share = np.exp((total - total[best]) / math.sqrt(scored))
        return model.languages[best], float(1 / share.sum())


def _logs(rows: pa.Table, languages: list[str], totals: dict[str, int]) -> tuple[dict[str, int], np.ndarray]:
    coded = rows["unit"].combine_chunks().dictionary_encode()
    order = {u: i for i, u in enumerate(sorted(coded.dictionary.to_pylist()))}
    place = np.array([order[u] for u in coded.dictionary.to_pylist()], np.int64)
    at = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(order), len(languages)))
    lang = np.array([at[x] for x in rows["lang"].to_pylist()], np.int64)
    counts[place[coded.indices.to_numpy()], lang] = rows["n"].to_numpy()
    size = np.array([totals.get(name, 0) for name in languages], float)
    return order, np.log((counts + SMOOTHING) / (size + SMOOTHING * max(1, len(order))))


def train(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_words: int = MAX_WORDS,
          max_grams: int = MAX_GRAMS) -> Model:
    """Fit on rows of ``docs`` (``doc_id``, ``text``, ``lang``) that have both.

    Of more than ``max_documents`` rows, those whose hashed id is smallest are
    drawn (as a share of the hash's range, so the number is met on average)."""
    usable = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    rows = usable.count()
    if rows > max_documents:
        limit = int(max_documents / rows * 2**32)
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.col("lang")), F.lit(2**32)) < limit)

    def count(batches):
        words: dict[str, Counter] = {}

        def rows():
            out = [(lang, _WORD, w, n) for lang, c in words.items() for w, n in c.items()]
            for lang, c in words.items():
                grams = Counter()
                for w, n in c.items():
                    for size in range(1, min(LONGEST, len(w) + 2) + 1):
                        for g in grams_of(w, size):
                            grams[g] += n
                out += [(lang, _GRAM, g, n) for g, n in grams.items()]
            words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))],
                names=["lang", "kind", "unit", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, words.values())) > CACHE_WORDS:
                    yield rows()
        yield rows()

    parts = usable.select("lang", "text").mapInArrow(count, "lang string, kind string, unit string, n long")
    counts = written(parts.groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n")), "language-counts")
    sums = counts.groupBy("kind", "lang").agg(F.sum("n").alias("total"))
    totals = {(r.kind, r.lang): r.total for r in sums.collect()}      # languages of at most max_documents rows
    languages = sorted({lang for _, lang in totals})
    if not languages:
        return Model([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)), 0)
    share = counts.join(F.broadcast(sums), ["kind", "lang"]).withColumn("share", F.col("n") / F.col("total"))
    top = share.groupBy("kind", "unit").agg(F.max("share").alias("share"))
    tables = {}
    for kind, most in ((_WORD, max_words), (_GRAM, max_grams)):
        kept = top.where(F.col("kind") == kind).orderBy(F.desc("share"), "unit").limit(most).select("kind", "unit")
        found = counts.join(kept, ["kind", "unit"]).select("unit", "lang", "n").toArrow()
        tables[kind] = _logs(found, languages, {lang: totals.get((kind, lang), 0) for lang in languages})
    common = max(range(len(languages)), key=lambda i: totals.get((_WORD, languages[i]), 0))
    return Model(languages, *tables[_WORD], *tables[_GRAM], common)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any others) as ``doc_id, lang_pred,
    score``."""
    load = shared_value(docs.sparkSession, model)

    def each(batches):
        scorer = Scorer(load())
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        each, "doc_id long, lang_pred string, score double")


def learned_from(modulus: int = 4, remainder: int = 2) -> Column:
    """Rows whose id's crc32 doesn't leave ``remainder``; null ids are learned from."""
    return F.coalesce(fold(F.col("doc_id"), modulus) != remainder, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` outside the held-out fold and
    predict all of them: ``doc_id, held_out, lang_pred, score``."""
    found = predict(docs, train(docs.where(learned_from())))
    return found.select("doc_id", (~learned_from()).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that have no language (no letter in the
    text). ``lang`` becomes the predicted language where it is null or the
    score at least ``CERTAIN``; if nothing was learned, it stays.

    Only text and label go through Python; the other columns stay in the JVM."""
    load = shared_value(docs.sparkSession, model)
    held = []

    @F.arrow_udf("string")
    def language(text: pa.Array, lang: pa.Array) -> pa.Array:
        if not held:
            held.append(Scorer(load()))
        out = []
        for t, given in zip(text, lang, strict=True):
            t = t.as_py()
            found, score = held[0].predict(t)
            if found == UNDETERMINED and not (t and _has_letter(words_of(t))):
                out.append(None)
            elif found == UNDETERMINED or given.is_valid and score < CERTAIN:
                out.append(given.as_py() or "")
            else:
                out.append(found)
        release_memory()
        return pa.array(out, pa.string())

    name = fresh_name(docs, "found_language")
    # evaluated once, not for the filter and the label
    found = docs.withColumn(name, language.asNondeterministic()(F.col("text").cast("string"), F.col("lang").cast("string")))
    label = F.nullif(F.col(name), F.lit(""))            # empty: neither given nor learned
    return found.where(F.col(name).isNotNull()).select(
        *[label.cast(docs.schema["lang"].dataType).alias(c) if c == "lang" else quoted(c) for c in docs.columns])
