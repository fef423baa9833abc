"""Substring de-duplication by winnowed anchors.

It stands in for relative Lempel-Ziv parsing, which factors every document
against every reference block: measured, far over any budget, and growing with
the square of the corpus (README). What a factor of ``window`` words or more
would find is found here by anchors that all blocks agree on.

The corpus is dealt into reference blocks. Each block is indexed by anchors:
the smallest hash among the short word grams of every ``window`` consecutive
words (the rightmost of equal ones), so two equal windows always have the
same anchor, and an anchor that occurs once rules its windows out. For the
anchors that repeat, each document is factored: the run of windows around an
anchor is one factor if its whole word sequence starts earlier somewhere.
Where runs with the same anchor differ (at the boundaries of a repeated
passage), their windows are compared one by one. Spans of removed windows
are joined per document at the end.

Nothing is sampled and no index bucket is capped. A block settles repeats
among its own documents by itself and hands on one row per distinct anchor,
run or window, so a passage that a third of all documents share costs each
later step one row per block. Hashes of runs and windows are compared with
128 bits.

Defined results: a null text has no words. Rows without an id stand after
all others, as one document. Rows that repeat an id are read one after the
other, in the order of their texts, as parts of one document (no window
reaches from one into the next). Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import block_table, chunks, mix64, text_bytes, word_spans, written
from corvid.llm.hashing import prefix_sums, slice_hashes, word_hashes

WINDOW = 20
GRAM = 6
NULL_ID = (1 << 63) - 1
CHUNK_BYTES = 1 << 20
# Texts of a reference block.
BLOCK_BYTES = 8 << 20

# Odd multipliers of the rolling sums.
_GRAM_BASE = 0xD6E8FEB86659FD93
_RUN_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


class Words:
    """The words of a block's documents: hashes, where each row's begin, and
    the place of each word in its document."""

    def __init__(self, table: pa.Table):
        table = _ordered(table)
        data, offsets = text_bytes(table["text"].combine_chunks())
        self.ids = _ids(table["doc_id"])
        hashes, counts = [], np.zeros(len(self.ids), np.int64)
        for a, b in chunks(offsets, CHUNK_BYTES):
            start, end, row = word_spans(data, offsets[a:b + 1])
            counts[a:b] = np.bincount(row, minlength=b - a)
            hashes.append(word_hashes(data[offsets[a]:offsets[b]], start, end))
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.append(0, np.cumsum(counts))
        self.counts = counts
        # rows that repeat an id follow each other and count on
        self.by_id = np.argsort(self.ids, kind="stable")
        self.sorted_ids = self.ids[self.by_id]
        self.begin = self.first[:-1][self.by_id[np.searchsorted(self.sorted_ids, self.ids)]]

    def places(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and place in it of word positions."""
        row = np.searchsorted(self.first, position, side="right") - 1
        return self.ids[row], position - self.begin[row]

    def positions(self, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Word positions of places in documents of this block."""
        row = self.by_id[np.searchsorted(self.sorted_ids, doc)]
        return self.begin[row] + place

    def windows(self, window: int) -> np.ndarray:
        """Word positions where a whole window of one document starts."""
        usable = np.maximum(self.counts - window + 1, 0)
        total = int(usable.sum())
        skipped = np.repeat(self.first[:-1] - np.append(0, np.cumsum(usable)[:-1]), usable)
        return np.arange(total) + skipped


def _anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and anchor hash of every run of consecutive
    windows that have the same anchor."""
    start = words.windows(window)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    grams = len(words.hash) - gram + 1
    position = np.arange(grams)
    value = slice_hashes(prefix_sums(words.hash, _GRAM_BASE), _GRAM_BASE, position, position + gram)
    gram_hash, span, width = value, 1, window - gram + 1
    while span < width:
        step = min(span, width - span)
        right = value[step:]
        take = right <= value[:-step]
        position = np.where(take, position[step:], position[:-step])
        value = np.where(take, right, value[:-step])
        span += step
    chosen = position[start]
    fresh = np.append(True, (np.diff(chosen) != 0) | (np.diff(start) != 1))
    edges = np.flatnonzero(fresh)
    return start[edges], np.diff(np.append(edges, len(start))), gram_hash[chosen[edges]]


def _run_hashes(words: Words, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> list[np.ndarray]:
    extra = np.asarray(salt).astype(np.uint64)
    return [mix64(slice_hashes(prefix_sums(words.hash, base), base, start, end) + extra) for base in _RUN_BASES]


def _first_of(keys: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each row is the one of its key with the smallest (id, start)."""
    order = np.lexsort((start, ids, *keys[::-1]))
    first = np.ones(len(order), bool)
    if len(order):
        same = np.ones(len(order) - 1, bool)
        for k in keys:
            same &= k[order][1:] == k[order][:-1]
        first[order[1:][same]] = False
    return first


def _ordered(table: pa.Table) -> pa.Table:
    """Rows that repeat an id side by side, in the order of their texts."""
    ids = table["doc_id"]
    if len(ids.unique()) == len(ids):
        return table
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy()


def _joined(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removed runs of windows, joined where they follow each other."""
    order = np.lexsort((start, doc))
    doc, start, count = doc[order], start[order], count[order]
    if not len(doc):
        return doc, start, count
    follows = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + count[:-1])
    head = np.flatnonzero(np.append(True, ~follows))
    return doc[head], start[head], np.add.reduceat(count, head)


_FOUND = "kind int, block int, doc long, start int, windows int, a long, b long"
_REMOVED, _RUN, _WINDOW = 0, 1, 2


def _rows(kind: int, block: int, doc, start, windows, a=None, b=None) -> pa.Table:
    n = len(doc)
    zero = np.zeros(n, np.int64)
    as_long = lambda x: zero if x is None else x.view(np.int64)
    return pa.table({
        "kind": pa.array(np.full(n, kind, np.int32)), "block": pa.array(np.full(n, block, np.int32)),
        "doc": pa.array(np.asarray(doc, np.int64)), "start": pa.array(np.asarray(start).astype(np.int32)),
        "windows": pa.array(np.asarray(windows).astype(np.int32)), "a": pa.array(as_long(a)), "b": pa.array(as_long(b))})


def repeated_spans(blocks: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``block, doc, start, windows``: the windows of each document (null id:
    the largest long) that also start earlier, as runs of start positions.
    ``blocks``: block, doc_id, text, dealt by doc_id."""

    def own_anchors(key, table):
        found = _anchors(Words(table), window, gram)[2]
        value, count = np.unique(found, return_counts=True)
        return pa.table({"block": pa.array(np.full(len(value), key[0].as_py(), np.int32)),
                         "anchor": pa.array(value.view(np.int64)), "repeats": pa.array(count > 1)})

    anchors = written(blocks.groupBy("block").applyInArrow(own_anchors, "block int, anchor long, repeats boolean"),
                      "anchors")
    repeated = written(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("repeats").alias("r"))
                       .where("n > 1 or r").select("anchor"), "repeated-anchors")
    wanted = anchors.select("block", "anchor").join(repeated, "anchor")

    def own_runs(key, table, known):
        block, words = key[0].as_py(), Words(table)
        start, count, anchor = _anchors(words, window, gram)
        keep = np.isin(anchor, known["anchor"].to_numpy().view(np.uint64))
        start, count, anchor = start[keep], count[keep], anchor[keep]
        doc, place = words.places(start)
        a, b = _run_hashes(words, start, start + count + window - 1, count)
        first = _first_of([a, b], doc, place)
        gone = _joined(doc[~first], place[~first], count[~first])
        # equal runs have equal anchors, so the anchor and one hash tell runs apart
        return pa.concat_tables([
            _rows(_REMOVED, block, *gone),
            _rows(_RUN, block, doc[first], place[first], count[first], anchor[first], (a ^ b)[first])])

    found = written(blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        _skip_empty(own_runs), _FOUND), "runs")
    runs = found.where(F.col("kind") == _RUN)
    # a: anchor, b: run; one row per run and block, a document is in one block
    run = written(runs.groupBy("a", "b").agg(F.min("doc").alias("doc"), F.min_by("start", "doc").alias("start"),
                                             F.min_by("block", "doc").alias("block"),
                                             F.max("windows").alias("windows"), F.count(F.lit(1)).alias("n")), "run-firsts")
    several = run.where("n > 1").select("a", "b", F.col("doc").alias("first_doc"))
    moved = runs.join(several, ["a", "b"]).where("doc != first_doc").select("block", "doc", "start", "windows")
    mixed = written(run.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
                    .where("low != high").select("a"), "mixed-anchors")
    unsure = run.join(mixed, "a").select("block", "doc", "start", "windows")

    def own_windows(key, table, asked):
        block, words = key[0].as_py(), Words(table)
        begin = words.positions(asked["doc"].to_numpy(), asked["start"].to_numpy().astype(np.int64))
        each = asked["windows"].to_numpy().astype(np.int64)
        start = np.repeat(begin - np.append(0, np.cumsum(each)[:-1]), each) + np.arange(int(each.sum()))
        doc, place = words.places(start)
        a, b = _run_hashes(words, start, start + window)
        first = _first_of([a, b], doc, place)
        one = np.ones(len(start), np.int64)
        gone = _joined(doc[~first], place[~first], one[~first])
        return pa.concat_tables([
            _rows(_REMOVED, block, *gone),
            _rows(_WINDOW, block, doc[first], place[first], one[first], a[first], b[first])])

    tested = written(blocks.groupBy("block").cogroup(unsure.groupBy("block")).applyInArrow(
        _skip_empty(own_windows), _FOUND), "windows")
    single = tested.where(F.col("kind") == _WINDOW)
    firsts = written(single.groupBy("a", "b").agg(F.min("doc").alias("first_doc"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").drop("n"), "window-firsts")
    later = single.join(firsts, ["a", "b"]).where("doc != first_doc").select("block", "doc", "start", "windows")
    spans = [t.where(F.col("kind") == _REMOVED).select("block", "doc", "start", "windows") for t in (found, tested)]
    return spans[0].unionByName(spans[1]).unionByName(moved).unionByName(later)


def _skip_empty(fn):
    """Blocks that one side of a cogroup lacks give no rows."""
    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _rows(_REMOVED, 0, *[np.zeros(0, np.int64)] * 3)
        return fn(key, left, right)

    return run


def _kept_words(text: str | None, starts: np.ndarray, ends: np.ndarray) -> tuple[int, list[bytes]]:
    words = (text or "").encode().split()
    if not len(starts):
        return len(words), words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.clip(starts, 0, len(words)), 1)
    np.add.at(cover, np.clip(ends, 0, len(words)), -1)
    keep = np.cumsum(cover[:-1]) == 0
    return len(words), [w for w, k in zip(words, keep, strict=True) if k]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_removed`` and ``kept``: the
    words that no repeated window covers, joined by single spaces. Columns
    besides ``doc_id`` and ``text`` come back as the struct ``rest``."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")] if rest else []))
    blocks, _ = block_table(rows, F.col("doc_id"), rows.columns, "text", "substring", block_bytes)
    spans = repeated_spans(blocks.select("block", "doc_id", "text"), window, gram)

    def cut(key, table, spans):
        table = _ordered(table)
        ids, doc = _ids(table["doc_id"]), spans["doc"].to_numpy()
        order = np.argsort(doc, kind="stable")
        start = spans["start"].to_numpy().astype(np.int64)[order]
        end = start + spans["windows"].to_numpy()[order] + window - 1
        low, high = (np.searchsorted(doc[order], ids, side) for side in ("left", "right"))
        total, removed, kept, before = [], [], [], {}
        for i, text in enumerate(table["text"]):
            # rows that repeat an id count on
            shift = before.get(ids[i], 0)
            n, words = _kept_words(text.as_py(), start[low[i]:high[i]] - shift, end[low[i]:high[i]] - shift)
            before[ids[i]] = shift + n
            total.append(n)
            removed.append(n - len(words))
            kept.append(b" ".join(words).decode())
        return (table.drop_columns("block").append_column("n_words", pa.array(total, pa.int64()))
                .append_column("n_removed", pa.array(removed, pa.int64())).append_column("kept", pa.array(kept, pa.string())))

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in blocks.drop("block").schema.fields])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)


def cut_documents(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text`` (and ``n_chars``, if
    there, counted anew). Texts without repeats stay as they are; documents
    of which nothing is left go."""
    found = remove_repeats(docs, window, gram, block_bytes).where("n_removed = 0 or kept != ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))

    def column(c: str):
        if c == "doc_id":
            return F.col("doc_id").cast(docs.schema[c].dataType).alias(c)
        if c == "text":
            return text.alias(c)
        old = F.col("rest").getField(c)
        if c == "n_chars":
            old = F.when(F.col("n_removed") > 0, F.char_length("kept").cast(docs.schema[c].dataType)).otherwise(old)
        return old.alias(c)

    return found.select(*[column(c) for c in docs.columns])


def kept_digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

