"""Benchmark decontamination: a BM25 index of test items, block-max WAND, and
a check of question and answer.

The test items are indexed by their words; an item longer than ``SPAN`` words
is indexed in segments of that length. Every training text is cut into
passages of two neighbouring spans, so a segment that stands in the text lies
whole in one passage. Each passage is a query: all segments whose BM25 score
reaches ``MIN_SCORE`` of what the segment scores against itself are
retrieved (impacts are stored as that share, so one threshold holds for all).
Block-max WAND skips postings by upper bounds of whole lists and of blocks of
segments. Passages that cannot reach the threshold are found for a whole batch
at once, before any list is opened: by the sum of whole lists' bounds, and by
what each segment gets from its essential words, those left when its commonest
words (``SPARE`` of its score at most) are taken to be all there. A retrieved
item counts as leaked if both its question (all sentences but the last) and
its answer (the last; halves of a single sentence) overlap with the text
around the passage: at least ``MIN_OVERLAP`` of their words stand there in
order.

The index is broadcast in shards of at most ``SHARD_ITEMS`` items and
``SHARD_BYTES`` of text; a larger benchmark takes more shards, each read
against all training texts. Word statistics are of all items.

Items of fewer than ``MIN_ITEM_WORDS`` words say too little for a score; they
leak where all their words stand side by side. They are looked up in the same
pass as their shard's index. ``drop_leaked`` asks for question and answer, so
there an item of a single word drops no document.

Defined results: words are runs of letters and digits, lower-cased; runs of
scripts written without spaces give their character pairs. Null and empty texts
have none. Items of equal text each give a row; rows
that repeat a document's id each give their rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import fresh_name, quoted, release_memory, shared_value, written
from corvid.llm.pagediff import common_lines

SPAN = 64
MIN_SCORE = 0.6
MIN_OVERLAP = 0.8
MIN_ITEM_WORDS = 5
K1, B = 1.2, 0.75
# Segments per block of a posting list.
BLOCK = 8
# Share of a segment's own score that its commonest words may make up before
# their postings count as essential; below MIN_SCORE.
SPARE = 0.3
SHARD_ITEMS = 20_000
SHARD_BYTES = 16 << 20
CHUNK_CHARS = 1 << 20
WORDS = re.compile(r"[^\W_]+")
# Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Han.
_UNSPACED = ("\u0e01-\u0e4e\u0e80-\u0eff\u1000-\u104f\u1780-\u17d3\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff"
             "\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_MIXED = re.compile(f"([{_UNSPACED}]+)|[^\\W_{_UNSPACED}]+")


def runs_of(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORDS.findall(text.lower()) if text else []


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits; of unspaced scripts, their character pairs."""
    if not text or text.isascii() or not _ANY_UNSPACED.search(text):
        return runs_of(text)
    words = []
    for found in _MIXED.finditer(text.lower()):
        run = found[0]
        words += [run[i:i + 2] for i in range(max(1, len(run) - 1))] if found[1] else [run]
    return words


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last."""
    parts = [w for w in (words_of(s) for s in re.split(r"(?<=[.!?])\s+|(?<=[。！？])|\n+", text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def overlap(part: list[str], text: list[str]) -> float:
    """Share of the part's words that stand in the text in the same order."""
    return len(common_lines(part, text)) / len(part) if part else 1.0


@dataclass
class Item:
    item_id: int | None
    question: list[str]
    answer: list[str]

    @property
    def length(self) -> int:
        return len(self.question) + len(self.answer)


class Index:
    """Inverted index of segments. ``segments``: (item position, words), in
    the order of posting lists; ``idf``: by word."""

    def __init__(self, items: list[Item], segments: list[tuple[int, list[str]]], idf: dict[str, float], mean_length: float):
        # segments that share their commonest word side by side: blocks of
        # like segments have lower bounds
        segments = sorted(segments, key=lambda s: (min((idf[w], w) for w in s[1]), s[0]))
        self.items, self.item_of = items, [s[0] for s in segments]
        postings: dict[str, list[tuple[int, float]]] = {}
        for at, (_, words) in enumerate(segments):
            norm = K1 * (1 - B + B * len(words) / mean_length)
            weights = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in Counter(words).items()}
            own = sum(weights.values())
            for w, x in weights.items():
                postings.setdefault(w, []).append((at, x / own))
        self.terms = {w: i for i, w in enumerate(sorted(postings))}
        self.lists = [np.array([a for a, _ in postings[w]], np.int64) for w in self.terms]
        self.impacts = [np.array([x for _, x in postings[w]]) for w in self.terms]
        self.most = np.array([x.max() for x in self.impacts]) if self.terms else np.zeros(0)
        self.block_of, self.block_most = [], []
        for at, x in zip(self.lists, self.impacts, strict=True):
            block, start = np.unique(at // BLOCK, return_index=True)
            self.block_of.append(block)
            self.block_most.append(np.maximum.reduceat(x, start))
        # a segment's commonest words, up to SPARE of its score, are left out
        # of the essential lists: a passage that reaches the threshold has the
        # rest from words whose lists are short
        self.spare = np.zeros(len(segments))
        essential: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        own_terms: list[list[tuple[float, int, float]]] = [[] for _ in segments]
        for word, t in self.terms.items():
            for at, x in zip(self.lists[t].tolist(), self.impacts[t].tolist(), strict=True):
                own_terms[at].append((idf[word], t, x))
        for at, found in enumerate(own_terms):
            for _, t, x in sorted(found):
                if self.spare[at] + x <= SPARE:
                    self.spare[at] += x
                else:
                    essential[t].append((at, x))
        # essential lists, one after the other
        self.essential_first = np.append(0, np.cumsum([len(e) for e in essential])).astype(np.int64)
        self.essential_at = np.array([at for e in essential for at, _ in e], np.int64)
        self.essential_impact = np.array([x for e in essential for _, x in e])

    def above(self, terms: list[int], least: float) -> dict[int, float]:
        """All segments whose impacts over ``terms`` sum to at least
        ``least``, by block-max WAND."""
        found: dict[int, float] = {}
        cursors = [[int(self.lists[t][0]), 0, t] for t in terms]
        slack = 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for n, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= least - slack:
                    pivot = n
                    break
            if pivot is None:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            block, bound, last = target // BLOCK, 0.0, len(self.item_of)
            for _, _, t in cursors[:pivot + 1]:
                blocks = self.block_of[t]
                k = int(np.searchsorted(blocks, block))
                if k < len(blocks) and blocks[k] == block:
                    bound += self.block_most[t][k]
            if pivot + 1 < len(cursors):
                last = cursors[pivot + 1][0]
            if bound < least - slack:
                # nothing in this block reaches the threshold by these lists
                self._advance(cursors, pivot + 1, min((block + 1) * BLOCK, last) if last > target else target + 1)
            elif cursors[0][0] == target:
                score = sum(self.impacts[t][at] for segment, at, t in cursors[:pivot + 1] if segment == target)
                if score >= least - slack:
                    found[target] = score
                self._advance(cursors, pivot + 1, target + 1)
            else:
                self._advance(cursors, pivot + 1, target)
        return found

    def _advance(self, cursors: list[list[int]], count: int, target: int) -> None:
        """Move the first ``count`` cursors to segments >= target."""
        for c in cursors[:count]:
            if c[0] < target:
                c[1] = int(np.searchsorted(self.lists[c[2]], target))
                c[0] = int(self.lists[c[2]][c[1]]) if c[1] < len(self.lists[c[2]]) else -1
        cursors[:] = [c for c in cursors if c[0] >= 0]

    def hopeful(self, span: np.ndarray, term: np.ndarray, joined: np.ndarray, least: float) -> np.ndarray:
        """Which passages (span i and, if ``joined[i]``, span i + 1) can have
        a segment at ``least`` or more, by sums of bounds.
        ``span``, ``term``: the distinct pairs, sorted."""
        def passages(sums):
            return sums + np.where(joined, np.append(sums[1:], 0.0), 0.0)

        count, segments = len(joined), len(self.item_of)
        open_ = passages(np.bincount(span, self.most[term], count)) >= least - 1e-9
        if not open_.any() or least <= SPARE:
            return np.flatnonzero(open_)
        # what each segment gets from essential words in the spans of open passages
        needed = open_ | np.append(False, open_[:-1] & joined[:-1])
        keep = needed[span]
        span, term = span[keep], term[keep]
        size = np.diff(self.essential_first)[term]
        at = np.repeat(self.essential_first[term] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(int(size.sum()))
        key, where = np.unique(np.repeat(span, size) * segments + self.essential_at[at], return_inverse=True)
        bound = np.bincount(where, self.essential_impact[at], len(key))
        own, segment = np.divmod(key, segments)
        asked = least - 1e-9 - self.spare[segment]
        # a passage's sum for a segment: that of its span and of the next
        after = np.searchsorted(key, key + segments)
        both = (after < len(key)) & joined[own]
        both[both] = key[after[both]] == key[both] + segments
        total = bound.copy()
        total[both] += bound[after[both]]
        good = np.zeros(count, bool)
        good[own[total >= asked]] = True
        # segments that only the second span has a word of
        late = (own > 0) & (bound >= asked)
        late[late] = joined[own[late] - 1]
        good[own[late] - 1] = True
        return np.flatnonzero(good & open_)

    def leaks(self, all_words: list[list[str]], least: float = MIN_SCORE, share: float = MIN_OVERLAP) -> list[tuple]:
        """Rows (text position, item, score, question, answer, first word) of
        the leaked items of a batch of texts, given as words."""
        if not self.terms:
            return []
        get, spans, codes, begin, at = self.terms.get, [], [], [], 0
        joined: list[np.ndarray] = []
        for words in all_words:
            code = np.array([get(w, -1) for w in words], np.int64)
            known = np.flatnonzero(code >= 0)
            count = -(-len(words) // SPAN)
            codes.append(code[known])
            spans.append(known // SPAN + at)
            more = np.ones(count, bool)
            more[-1:] = False
            joined.append(more)
            begin.append(at)
            at += count
        if not at:
            return []
        joined_all = np.concatenate(joined)
        key = np.unique(np.concatenate(spans) * len(self.terms) + np.concatenate(codes))
        span, term = np.divmod(key, len(self.terms))
        edges = np.searchsorted(span, np.arange(at + 1))
        out, owner = {}, np.array(begin)
        for passage in self.hopeful(span, term, joined_all, least).tolist():
            until = passage + 2 if joined_all[passage] else passage + 1
            terms = np.unique(term[edges[passage]:edges[until]]).tolist()
            found = self.above(terms, least)
            if not found:
                continue
            text = int(np.searchsorted(owner, passage, side="right")) - 1
            words, first = all_words[text], (passage - begin[text]) * SPAN
            for segment, score in found.items():
                item = self.items[self.item_of[segment]]
                around = words[max(0, first - item.length):first + 2 * SPAN + item.length]
                asked, told = overlap(item.question, around), overlap(item.answer, around)
                if asked >= share and told >= share:
                    row = (text, item.item_id, float(score), asked, told, first)
                    key = (text, self.item_of[segment])
                    out[key] = max(out.get(key, row), row, key=lambda r: (r[3] + r[4], r[2], -r[5]))
        return list(out.values())


def _segments(words: list[str]) -> list[list[str]]:
    return [words[i:i + SPAN] for i in range(0, len(words), SPAN)]


def build_searchers(items: DataFrame):
    """Searchers over ``items`` (``item_id``, ``text``), one shard at a time."""
    rows = written(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                   .where("text is not null"), "items")
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not count:
        return

    def terms(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                if len(words) >= MIN_ITEM_WORDS:
                    out += [(w, len(part)) for part in _segments(words) for w in set(part)] + [
                        (None, len(part)) for part in _segments(words)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                              pa.array([o[1] for o in out], pa.int64())], names=["term", "length"])

    held = written(rows.select("text").mapInArrow(terms, "term string, length long").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("length").alias("length")), "item-terms")
    whole = held.where("term is null").first()
    shards = max(-(-count // SHARD_ITEMS), -(-size // SHARD_BYTES))
    for shard in range(shards):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        found, segments, short = [], [], []
        for row in part.orderBy("item_id", "text").collect():      # at most a shard, on average
            words = words_of(row.text)
            if len(words) >= MIN_ITEM_WORDS:
                segments += [(len(found), s) for s in _segments(words)]
                found.append(Item(row.item_id, *question_and_answer(row.text)))
            elif words:
                short.append((row.item_id, words))
        if not segments:
            if short:
                yield Searcher(None, short)
            continue
        used = part.select("text").mapInArrow(terms, "term string, length long").select("term").distinct()
        df = {r.term: r.df for r in held.join(used, "term").collect()}      # the shard's words
        idf = {w: float(np.log(1 + (whole.df - n + 0.5) / (n + 0.5))) for w, n in df.items()}
        yield Searcher(Index(found, segments, idf, whole.length / whole.df), short)


_SPEC = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


class Searcher:
    """One shard of items: the index of those long enough to score, and the
    word sequences of the short ones."""

    def __init__(self, index: Index | None, short: list[tuple[int | None, list[str]]]):
        self.index = index
        #: first word -> sequence -> ids of the items that are this sequence
        self.short: dict[str, dict[str, list[int | None]]] = {}
        for item_id, words in short:
            self.short.setdefault(words[0], {}).setdefault(" ".join(words), []).append(item_id)
        self.lengths = {w: sorted({key.count(" ") + 1 for key in keys}) for w, keys in self.short.items()}

    def leaks(self, texts: list[str | None], least: float = MIN_SCORE, share: float = MIN_OVERLAP) -> list[tuple]:
        """Rows (text position, item, score, question, answer, first word)."""
        all_words = [words_of(t) for t in texts]
        found = self.index.leaks(all_words, least, share) if self.index else []
        return found + self.short_leaks(all_words) if self.short else found

    def short_leaks(self, all_words: list[list[str]], least_words: int = 1) -> list[tuple]:
        """Short items of at least ``least_words`` words whose whole sequence
        stands in a text, each with its first place."""
        out = []
        for text, words in enumerate(all_words):
            seen: dict[str, int] = {}
            for i, word in enumerate(words):
                if word in self.short:
                    keys = self.short[word]
                    for n in self.lengths[word]:
                        key = " ".join(words[i:i + n])
                        if n >= least_words and key in keys:
                            seen.setdefault(key, i)
            out += [(text, item, 1.0, 1.0, 1.0, first) for key, first in seen.items() for item in self.short[key.split(" ")[0]][key]]
        return out

    def any_leak(self, texts: list[str | None]) -> list[bool]:
        """Whether a text holds question and answer of an item; a single word
        has no answer to its question, so it marks no text."""
        all_words = [words_of(t) for t in texts]
        rows = self.index.leaks(all_words) if self.index else []
        rows += self.short_leaks(all_words, least_words=2) if self.short else []
        found = {r[0] for r in rows}
        return [i in found for i in range(len(texts))]


def _runs(texts: list[str | None]):
    """Ranges of texts of about ``CHUNK_CHARS`` each."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (size < CHUNK_CHARS or end == start):
            size += len(texts[end] or "")
            end += 1
        yield start, end
        start = end


def find_all_leaks(docs: DataFrame, items: DataFrame, least: float = MIN_SCORE, share: float = MIN_OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap,
    first_word`` of every leaked item in ``docs`` (``doc_id``, ``text``).
    Texts are cut into words once for a shard of items, short ones included."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
    names = [part.split()[0] for part in _SPEC.split(", ")]
    result = None
    for searcher in build_searchers(items):
        load = shared_value(docs.sparkSession, searcher)

        def search(batches, load=load):
            searcher = load()
            for batch in batches:
                ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
                for start, end in _runs(texts):
                    out += [(ids[start + r[0]], *r[1:]) for r in searcher.leaks(texts[start:end], least, share)]
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)
            release_memory()

        part = rows.mapInArrow(search, _SPEC)
        result = part if result is None else result.unionByName(part)
    return result if result is not None else docs.sparkSession.createDataFrame([], _SPEC)


def _leak_test(spark: SparkSession, searcher: Searcher):
    """A function of a text column: whether the text holds an item."""
    load, held = shared_value(spark, searcher), []

    @F.arrow_udf("boolean")
    def leaked(text: pa.Array) -> pa.Array:
        if not held:
            held.append(load())
        texts, out = text.to_pylist(), []
        for start, end in _runs(texts):
            out += held[0].any_leak(texts[start:end])
        release_memory()
        return pa.array(out, pa.bool_())

    return leaked.asNondeterministic()              # evaluated once


def drop_leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold question and answer of an
    item. A row stays or goes by its own text, so there is no join: only texts
    go through Python, the other columns stay in the JVM."""
    for searcher in build_searchers(items):
        name = fresh_name(docs, "holds_item")
        found = _leak_test(docs.sparkSession, searcher)(F.col("text").cast("string"))
        docs = docs.withColumn(name, found).where(~quoted(name)).select(*[quoted(c) for c in docs.columns])
    return docs
