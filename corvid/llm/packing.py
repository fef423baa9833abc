"""Best-fit decreasing packing of token sequences.

Tokenizing cuts each document into pieces of at most ``capacity`` tokens.
Packing then depends on the pieces' lengths only, so the plan is computed
from the histogram of lengths (at most ``capacity`` rows, whatever the
corpus): lengths are taken from the longest down, each piece goes to the
tightest open sequence that can hold it, and a segment tree over remaining
capacities finds that sequence in logarithmic time. Sequences of equal
remaining capacity are interchangeable, so the pieces of one length are
placed a run of sequences at a time; the result is exactly best-fit
decreasing over all pieces. The plan is a bounded list of runs; Spark ranks
the pieces within each length and each task looks its pieces' places up.

Defined results: a null text is an empty one, and an empty document is one
piece that holds the end id alone. Repeated rows are packed as often as they
occur. Null ids are kept. Extra columns are not read. No row is dropped.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import written

CAPACITY = 2048
END_ID = 0
# Ids of words already tokenized, kept per Python worker; a full cache is
# emptied, so its memory is bounded and results don't depend on it.
CACHE_WORDS = 700_000
# Texts outside Latin-1 go through the tokenizer as a whole.
_BYTE_RANGE = 256


def _latin_word_pattern() -> re.Pattern:
    """The vocabulary's word pattern for Latin-1 text, with the classes of
    letters, digits and white space listed from the Unicode categories."""
    def chars(test) -> str:
        return "".join(re.escape(chr(c)) for c in range(_BYTE_RANGE) if test(chr(c)))

    letters = chars(lambda c: unicodedata.category(c)[0] == "L")
    digits = chars(lambda c: unicodedata.category(c)[0] == "N")
    spaces = re.escape("\t\n\x0b\x0c\r \x85\xa0")
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{digits}]|[^{spaces}{letters}{digits}]+")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the others in order from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer(dict):
    """Token ids as little-endian 32-bit bytes, by a vocabulary whose pieces
    never reach across words: each distinct word is tokenized once and kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # texts that hold an added token go through the library as a whole
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.find_added = re.compile("|".join(map(re.escape, added)), re.I).search if added else None
        self.model = self.library.model
        self.find_words = _latin_word_pattern().findall
        self.byte_characters = _byte_characters()

    def __missing__(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.byte_characters)
        ids = self[word] = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        lowered = text.lower()
        try:
            lowered.encode("latin-1")
            whole = self.find_added is not None and self.find_added(text) is not None
        except UnicodeEncodeError:
            whole = True
        if whole:
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, self.find_words(lowered)))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length,
    ids_crc32`` and, with ``keep_ids``, the ``token_ids`` themselves."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    width = 4 * capacity
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("token_ids", pa.list_(pa.int64()))] * keep_ids
    schema = pa.schema(fields)

    def cut(batches):
        encode = tokenizer(vocabulary).encode
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id, ids = doc_id.as_py(), encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    values = [doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)]
                    if keep_ids:
                        values.append(np.frombuffer(part, dtype="<u4").astype(np.int64))
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, type=kind) for column, (_, kind) in zip(rows, fields, strict=True)], schema=schema)

    spec = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", token_ids array<long>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, spec)


class CapacityTree:
    """Segment tree over remaining capacities 0..size: which of them open
    sequences have, and the tightest one of at least a given length."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.marked = [False] * (2 * self.leaves)

    def set(self, capacity: int, present: bool) -> None:
        node = capacity + self.leaves
        self.marked[node] = present
        node //= 2
        while node:
            self.marked[node] = self.marked[2 * node] or self.marked[2 * node + 1]
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest marked capacity >= length."""
        node = length + self.leaves
        if self.marked[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.marked[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.marked[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass
class Runs:
    """Places of the pieces of one length, by rank: from rank ``first[i]`` on,
    ``each[i]`` pieces go to every sequence from ``sequence[i]`` on, the first
    of them at ``offset[i]``."""

    first: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)

    def place(self, length: int, rank: int) -> tuple[int, int]:
        i = bisect_right(self.first, rank) - 1
        step, slot = divmod(rank - self.first[i], self.each[i])
        return self.sequence[i] + step, self.offset[i] + slot * length


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, Runs]:
    """Best-fit decreasing over ``{length: pieces}``."""
    tree = CapacityTree(capacity)
    #: remaining capacity -> runs of sequences [first, count]
    open_runs: dict[int, list[list[int]]] = {}
    used, plan = 0, {}

    def put(remaining: int, first: int, count: int) -> None:
        if count and remaining:
            open_runs.setdefault(remaining, []).append([first, count])
            tree.set(remaining, True)

    for length in sorted(histogram, reverse=True):
        left, runs = histogram[length], Runs()

        def place(first: int, remaining: int, count: int, each: int, length=length, runs=runs, rank=histogram[length]):
            runs.first.append(rank - left)
            runs.sequence.append(first)
            runs.each.append(each)
            runs.offset.append(capacity - remaining)
            put(remaining - each * length, first, count)

        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    place(used, capacity, whole, each)
                    left -= whole * each
                    used += whole
                if rest:
                    place(used, capacity, 1, rest)
                    left -= rest
                    used += 1
                continue
            each = remaining // length
            run = open_runs[remaining].pop()
            if not open_runs[remaining]:
                tree.set(remaining, False)
            whole = min(run[1], left // each)
            if whole:
                place(run[0], remaining, whole, each)
                left -= whole * each
            if whole < run[1]:
                rest = left
                if rest:
                    place(run[0] + whole, remaining, 1, rest)
                    left = 0
                put(remaining, run[0] + whole + bool(rest), run[1] - whole - bool(rest))
        plan[length] = runs
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_bucket: int = 100_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (any table with a
    ``length`` of 1..capacity, ``doc_id`` and ``piece``).

    ``per_bucket``: a length's pieces are ranked in buckets by a hash of their
    id, so no length is ranked by one task however common it is; the number of
    buckets is the piece count over this, at least 64."""
    spark = pieces.sparkSession
    # text order of ids breaks ties among repeated rows only
    key = F.xxhash64("doc_id", "piece")
    total = pieces.count()
    buckets = max(64, -(-total // per_bucket))
    keyed = pieces.withColumn("_bucket", F.pmod(key, F.lit(buckets)))
    counts = written(keyed.groupBy("length", "_bucket").count(), "pack-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    plan = best_fit_plan(histogram, capacity)
    before = counts.select("length", "_bucket", (F.sum("count").over(
        Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = (keyed.withColumn("_row", F.row_number().over(order))
              .join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
              .drop("_bucket", "_row", "_before"))
    tables = spark.sparkContext.broadcast({
        length: tuple(np.asarray(x, dtype=np.int64) for x in (r.first, r.sequence, r.each, r.offset))
        for length, r in plan.items()})

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length, rank):
        import pandas as pd

        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for rows in np.split(order, edges):
            if len(rows):
                size = int(lengths[rows[0]])
                first, seq, each, off = tables.value[size]
                i = np.searchsorted(first, ranks[rows], side="right") - 1
                step, slot = np.divmod(ranks[rows] - first[i], each[i])
                sequence[rows], offset[rows] = seq[i] + step, off[i] + slot * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (ranked.withColumn("_place", place("length", "_rank"))
            .withColumn("sequence_id", F.col("_place.sequence_id"))
            .withColumn("offset", F.col("_place.offset"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (``doc_id``, ``text``)."""
    return pack(written(token_pieces(docs, vocabulary, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (needs ``keep_ids``): one row per
    sequence with its ``token_ids`` in place order and their documents."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "token_ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.token_ids").alias("token_ids"), F.col("parts.doc_id").alias("doc_ids"))
