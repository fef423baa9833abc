"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts: for every context of up to ``ORDER``
bytes, how often each byte followed it. A byte is coded in its longest known
context; if it never followed that context, an escape is coded and the next
shorter context is tried, from which the bytes that the longer one had are
excluded. A context that occurred T times with D different bytes gives the
escape D / (T + D) and a byte of count c the probability c / (T + D), both
over what is not excluded; below the empty context all bytes left are equally
likely. A text is preceded by ``ORDER`` zero bytes and ended by one, so
scores are of whole texts.

``score_documents`` trains on the documents that are not held out and scores
all. The probability of a byte depends on the ``ORDER`` bytes before it only,
so the corpus is counted as windows of ``ORDER + 1`` bytes: each block of
documents hands on its distinct windows and words with their counts, Spark
adds them up, works out each distinct window's probability by joins along the
context order, and deals the figures back to the blocks that asked for them.
No table of the model is broadcast or collected; a block holds only the
windows and words that it has itself.

``adaptive_code_length`` is the same model learned from each document alone
while it is coded.

Defined results: a null text is an empty one (one end, one window). A null id
is not held out. Rows that repeat an id are scored and learned from one by
one. Words are told apart by 64 bits of hash. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import block_table, chunks, fold, lower_ascii, text_bytes, word_spans, written
from corvid.llm.hashing import word_hashes

ORDER = 4
BLOCK_BYTES = 12 << 20
CHUNK_BYTES = 1 << 19
# The end of a text among the words' hashes.
END_WORD = 0
_WINDOW, _WORD = 0, 1


def _windows(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The byte windows of the rows ``offsets`` of ``data``, one for each byte
    and each end, row after row."""
    sizes = np.diff(offsets)
    rows = len(sizes)
    # order zero bytes, the text, one zero byte; then the next row
    padded = np.zeros(int(sizes.sum()) + rows * (order + 1), np.uint8)
    at = np.arange(int(sizes.sum())) + np.repeat((np.arange(rows) + 1) * (order + 1) - 1, sizes)
    padded[at] = lower_ascii(data[offsets[0]:offsets[-1]])
    wide = padded.astype(np.uint64)
    code = wide[:len(wide) - order].copy()
    for j in range(1, order + 1):
        code <<= np.uint64(8)
        code |= wide[j:len(wide) - order + j]
    # windows that reach from one row's end into the next are left out
    starts = offsets[:-1] - offsets[0] + np.arange(rows) * (order + 1)
    first = np.repeat(starts - np.append(0, np.cumsum(sizes + 1)[:-1]), sizes + 1)
    return code[first + np.arange(int((sizes + 1).sum()))]


def _counted(values: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the sums of their weights."""
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate(values), return_inverse=True)
    return found, np.bincount(at, np.concatenate(weights), len(found)).astype(np.int64)


class _Counter:
    """Distinct values of many chunks with their counts in training rows."""

    def __init__(self):
        self.values, self.counts = [], []

    def add(self, values: np.ndarray, learn: np.ndarray) -> None:
        for part, weight in ((values[learn], 1), (values[~learn], 0)):
            found, count = np.unique(part, return_counts=True)
            self.values.append(found)
            self.counts.append(count * weight)
        if len(self.values) > 24:
            merged = self.total()
            self.values, self.counts = [merged[0]], [merged[1]]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return _counted(self.values, self.counts)


class Lookup:
    """Figures by 64-bit key for whole arrays of keys that are all present."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys)).bit_length() + 2)
        order = np.argsort(self._slot(keys), kind="stable")
        self.keys, self.order = keys[order], order
        slots = self._slot(self.keys)
        self.first = np.searchsorted(slots, np.arange(1 << self.bits)).astype(np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions among the keys given at first."""
        at = self.first[self._slot(keys)]
        last = len(self.keys) - 1
        wrong = np.flatnonzero(self.keys[np.minimum(at, last)] != keys)
        while len(wrong):
            at[wrong] += 1
            if int(at[wrong].max()) > last:
                raise KeyError("a key is not in the table")
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.order[at]


def window_scores(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, log10p`` for all windows in ``grams`` (gram, n: how often it
    occurred in training, 0 if it is only to be scored)."""
    level = {order: written(grams.where("n > 0"), f"grams{order}")}
    for k in range(order - 1, -1, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        level[k] = written(level[k + 1].groupBy(low.alias("gram")).agg(F.sum("n").alias("n")), f"grams{k}")
    contexts = {}
    for k in range(order, -1, -1):
        of = F.shiftright("gram", 8).alias("context")
        if k:
            # x: how much of the next shorter context's count this one's bytes have
            low = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
            shorter = level[k - 1].select(F.col("gram").alias("low"), F.col("n").alias("m"))
            counted = level[k].withColumn("low", low).join(shorter, "low")
            excluded = F.sum("m")
        else:
            counted, excluded = level[0], F.lit(0).cast("long")
        contexts[k] = written(counted.groupBy(of).agg(
            F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), excluded.alias("x")), f"contexts{k}")

    longest = contexts[order].select("context", "t", "d")
    seen = (level[order].withColumn("context", F.shiftright("gram", 8)).join(longest, "context")
            .select("gram", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("log10p")))
    # windows that training lacks: down the contexts; lost and less are the
    # counts and bytes that the last known context excludes here
    state = grams.where("n = 0").select("gram", F.lit(0.0).alias("log10p"), F.lit(False).alias("done"),
                                        F.lit(0).cast("long").alias("lost"), F.lit(0).cast("long").alias("less"))
    for k in range(order, -1, -1):
        stats = contexts[k]
        counts = level[k].select(F.col("gram").alias("own"), F.col("n").alias("c"))
        state = (state.withColumn("context", F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)), 8))
                 .withColumn("own", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)))
                 .join(stats, "context", "left").join(counts, "own", "left"))
        t, d = F.col("t") - F.col("lost"), F.col("d") - F.col("less")
        known = ~F.col("done") & F.col("t").isNotNull()
        codes = known & (d > 0)
        hit = codes & F.col("c").isNotNull()
        state = state.select(
            "gram",
            (F.col("log10p") + F.when(hit, F.log10(F.col("c") / (t + d))).when(codes, F.log10(d / (t + d)))
             .otherwise(0.0)).alias("log10p"),
            (F.col("done") | hit).alias("done"),
            F.when(known, F.col("x")).otherwise(F.col("lost")).alias("lost"),
            F.when(known, F.col("d")).otherwise(F.col("less")).alias("less"))
    unseen = state.select("gram", F.when(F.col("done"), F.col("log10p")).otherwise(
        F.col("log10p") - F.log10(256 - F.col("less"))).alias("log10p"))
    return written(seen.unionByName(unseen), "window-scores")


def score_documents(docs: DataFrame, held_out, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` for every row of ``docs`` (``doc_id``, ``text``).

    ``held_out``: a boolean column; rows for which it is true are not learned
    from. ``score``: log10 probability of the text; ``base_score``: that of a
    word model with one added to every count."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks, _ = block_table(rows, F.struct("doc_id", "text"), ["doc_id", "text", "held_out"], "text", "ppm", block_bytes)

    def own_counts(key, table):
        data, offsets = text_bytes(table["text"].combine_chunks())
        learn = ~table["held_out"].to_numpy().astype(bool)
        windows, words = _Counter(), _Counter()
        for a, b in chunks(offsets, CHUNK_BYTES):
            part = offsets[a:b + 1]
            windows.add(_windows(data, part, order), np.repeat(learn[a:b], np.diff(part) + 1))
            text = lower_ascii(data[part[0]:part[-1]])
            start, end, row = word_spans(text, part - part[0])
            words.add(word_hashes(text, start, end), learn[a:b][row])
        words.add(np.full(len(learn), END_WORD, np.uint64), learn)
        parts = [(kind, *counter.total()) for kind, counter in ((_WINDOW, windows), (_WORD, words))]
        return pa.table({
            "block": pa.array(np.full(sum(len(p[1]) for p in parts), key[0].as_py(), np.int32)),
            "kind": pa.array(np.concatenate([np.full(len(p[1]), p[0], np.int32) for p in parts])),
            "gram": pa.array(np.concatenate([p[1] for p in parts]).view(np.int64)),
            "n": pa.array(np.concatenate([p[2] for p in parts]))})

    counted = written(blocks.groupBy("block").applyInArrow(own_counts, "block int, kind int, gram long, n long"),
                      "ppm-counts")
    windows = counted.where(F.col("kind") == _WINDOW)
    words = counted.where(F.col("kind") == _WORD)
    scored = window_scores(written(windows.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-windows"), order)
    # a word has one row per block, so its rows can be summed over by a window
    same = Window.partitionBy("gram")
    figures = (windows.select("block", "gram").join(scored, "gram")
               .select("block", "gram", F.col("log10p").alias("value"), F.lit(_WINDOW).alias("kind"),
                       F.lit(False).alias("owner"))
               .unionByName(words.select(
                   "block", "gram", F.sum("n").over(same).cast("double").alias("value"), F.lit(_WORD).alias("kind"),
                   (F.min("block").over(same) == F.col("block")).alias("owner"))))

    def own_scores(key, table, figures):
        data, offsets = text_bytes(table["text"].combine_chunks())
        kind, gram = figures["kind"].to_numpy(), figures["gram"].to_numpy().view(np.uint64)
        value, owner = figures["value"].to_numpy(), figures["owner"].to_numpy().astype(bool)
        is_word = kind == _WORD
        log10p, count = value[~is_word], value[is_word]
        by_window, by_word = Lookup(gram[~is_word]), Lookup(gram[is_word])
        plus_one = np.log10(count + 1)
        end = by_word.find(np.array([END_WORD], np.uint64))
        rows = len(offsets) - 1
        score, tokens, known, logs = np.zeros(rows), np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows)
        for a, b in chunks(offsets, CHUNK_BYTES):
            part = offsets[a:b + 1]
            each = log10p[by_window.find(_windows(data, part, order))]
            first = part[:-1] - part[0] + np.arange(b - a)
            score[a:b] = np.add.reduceat(each, first)
            text = lower_ascii(data[part[0]:part[-1]])
            start, stop, row = word_spans(text, part - part[0])
            at = by_word.find(word_hashes(text, start, stop)) if len(start) else np.zeros(0, np.int64)
            tokens[a:b] = np.bincount(row, minlength=b - a) + 1
            known[a:b] = np.bincount(row, count[at] > 0, b - a).astype(np.int64) + int(count[end[0]] > 0)
            logs[a:b] = np.bincount(row, plus_one[at], b - a) + plus_one[end[0]]
        own = np.zeros(rows, np.int64)
        own[0] = int((owner[is_word] & (count > 0)).sum())
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"], "n_tokens": pa.array(tokens),
                         "n_known": pa.array(known), "logs": pa.array(logs), "score": pa.array(score),
                         "vocabulary": pa.array(own)})

    found = written(blocks.groupBy("block").cogroup(figures.groupBy("block")).applyInArrow(
        own_scores, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, "
                    "vocabulary long"), "ppm-scores")
    sizes = found.agg(
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.lit(0)).alias("train_tokens"),
        F.coalesce(F.sum("vocabulary"), F.lit(0)).alias("v"))
    per_token = F.log10(F.col("train_tokens") + F.col("v") + 1)
    return found.join(F.broadcast(sizes)).select(          # one row
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
        (F.col("logs") - F.col("n_tokens") * per_token).alias("base_score"), "score")


class Trie:
    """The model of one text or many, held in memory: counts of the bytes
    that followed each context."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[bytes, dict[int, int]] = {}

    def log10p(self, context: bytes, byte: int) -> float:
        total, excluded = 0.0, set()
        for k in range(len(context), -1, -1):
            here = self.counts.get(context[len(context) - k:])
            if here is None:
                continue
            left = {s: n for s, n in here.items() if s not in excluded}
            if left:
                mass = sum(left.values()) + len(left)
                if byte in left:
                    return total + math.log10(left[byte] / mass)
                total += math.log10(len(left) / mass)
            excluded |= here.keys()
        return total - math.log10(256 - len(excluded))

    def learn(self, context: bytes, byte: int) -> None:
        for k in range(len(context) + 1):
            here = self.counts.setdefault(context[len(context) - k:], {})
            here[byte] = here.get(byte, 0) + 1

    def steps(self, text: str):
        data = bytes(self.order) + text.encode().lower() + b"\0"
        for at in range(self.order, len(data)):
            yield data[at - self.order:at], data[at]


def adaptive_code_length(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, n_bytes, code_bits``: each text coded by a model that starts
    empty and learns every byte after coding it."""
    def code(batches):
        for batch in batches:
            bits, sizes = [], []
            for text in batch.column(1):
                trie, total = Trie(order), 0.0
                for context, byte in trie.steps(text.as_py() or ""):
                    total -= trie.log10p(context, byte)
                    trie.learn(context, byte)
                bits.append(total / math.log10(2))
                sizes.append(len((text.as_py() or "").encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bits, pa.float64())],
                                             names=["doc_id", "n_bytes", "code_bits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        code, "doc_id long, n_bytes long, code_bits double")


def held_out_fold(modulus: int = 7, remainder: int = 2):
    """crc32 of the id's text leaves ``remainder``."""
    return fold(F.col("doc_id"), modulus) == remainder
