"""SimHash near-duplicate groups by a Gray-order hierarchical index.

A document's fingerprint holds the majority bit of its word shingles'
64-bit hashes. Two fingerprints that differ in at most ``max_bits`` bits
agree on whole blocks of bits. That only routes them: for each choice of
blocks, fingerprints that agree there go to the same bucket, of about
``BUCKET_ROWS``, and together the choices bring every pair within reach to
one bucket. A bucket sorts its fingerprints by Gray rank, the chosen blocks'
bits first, which puts words that differ in few bits side by side; runs of
the order become nodes that factor out the bits all their members share. A
search starts from the top nodes for every fingerprint, adds up the
differences downwards and leaves a whole node as soon as they exceed the
limit. A bucket hands on a spanning star of its links, not all pairs;
components of those links are then found in Spark.

Defined results: null and empty texts have fingerprint zero and are linked
like any other. Equal fingerprints are one node, so copies cost one row.
Rows that repeat an id are rows of one document. A null id never becomes a
component's id unless all ids of the component are null. Extra columns are
not read. ``drop_near_duplicates`` keeps one row of each component: that of
the smallest id (null last), of those that of the smallest text hash, of equal
rows the first.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import fresh_name, quoted, release_memory, written
from corvid.llm.components import star_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Members of an index leaf and children of an upper node.
LEAF = 4
FANOUT = 4
# Queries that a search answers at once.
QUERIES = 256
# Fingerprints of one key that one index holds; keys with more are split
# into parts, and every pair of parts shares an index (none is left out).
PART = 4096
# Fingerprints of a bucket's index, on average.
BUCKET_ROWS = 8192


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64 (seed 42), as an unsigned int."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    last = ends[width - 1:].tolist()
    first = [0] + (ends[:len(last) - 1] + 1).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    major = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(major.view("<u8")[0])


def _fingerprint_of(text: Column, shingle: int) -> Column:
    """64 bits as a signed long; only the text goes through Python."""
    @F.arrow_udf("long")
    def bits(text: pa.Array) -> pa.Array:
        found = [fingerprint((t.as_py() or "").encode().lower().split(), shingle) for t in text]
        release_memory()
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return bits(text.cast("string"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _fingerprint_of(F.col("text"), shingle).alias("fp"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Index over fingerprints: levels of nodes over the Gray order, from the
    leaves' runs up; each node has the bits its members share and their values."""

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(gray_rank(words), kind="stable")
        self.words = words[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # shared bits, values, first child
        edges = np.arange(0, len(words), LEAF)
        ones, zeros = np.bitwise_and.reduceat(self.words, edges), np.bitwise_and.reduceat(~self.words, edges)
        self.levels.append((ones | zeros, ones, np.append(edges, len(words))))
        while len(self.levels[-1][0]) > FANOUT:
            edges = np.arange(0, len(ones), FANOUT)
            count = len(ones)
            ones, zeros = np.bitwise_and.reduceat(ones, edges), np.bitwise_and.reduceat(zeros, edges)
            self.levels.append((ones | zeros, ones, np.append(edges, count)))

        self.visited = self.pruned = 0              # nodes that searches came to, and left

    def within(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and member positions of all pairs of at most ``most``
        differing bits (members as given to the index)."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        top_mask, top_value, _ = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(top_mask))
        node = np.tile(np.arange(len(top_mask)), len(queries))
        apart = np.bitwise_count((queries[q] ^ top_value[node]) & top_mask[node]).astype(np.int64)
        seen = top_mask[node]
        for depth in range(len(self.levels) - 1, -1, -1):
            near = apart <= most
            self.visited += len(near)
            self.pruned += len(near) - int(near.sum())
            q, node, apart, seen = q[near], node[near], apart[near], seen[near]
            first = self.levels[depth][2]
            count = first[node + 1] - first[node]
            child = np.repeat(first[node] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            q, apart, seen = np.repeat(q, count), np.repeat(apart, count), np.repeat(seen, count)
            if depth:
                mask, value, _ = self.levels[depth - 1]
                # only the bits not counted in an upper node are added
                apart = apart + np.bitwise_count((queries[q] ^ value[child]) & mask[child] & ~seen)
                seen, node = mask[child], child
            else:
                apart = apart + np.bitwise_count((queries[q] ^ self.words[child]) & ~seen)
                near = apart <= most
                return q[near], self.order[child[near]]
        raise AssertionError("an index has a leaf level")


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position in each position's component."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new[label]
        alive = label[a] != label[b]
        a, b = a[alive], b[alive]
    return label


def key_first(words: np.ndarray, mask: int) -> np.ndarray:
    """The words with the bits of ``mask`` moved to the top (both kinds in
    their order), so that words of one key follow each other in Gray order."""
    out, at = np.zeros_like(words), 63
    runs: list[tuple[bool, int, int]] = []          # of the mask, lowest bit, width
    while at >= 0:
        kind, low = bool(mask >> at & 1), at
        while low and bool(mask >> (low - 1) & 1) == kind:
            low -= 1
        runs.append((kind, low, at - low + 1))
        at = low - 1
    for _, low, width in sorted(runs, key=lambda r: not r[0]):
        out = (out << np.uint64(width)) | ((words >> np.uint64(low)) & np.uint64((1 << width) - 1))
    return out


def links_of_bucket(words: np.ndarray, mask: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of the links among the words of a bucket, found by the
    Gray-order index over all of them: two aligned arrays of words."""
    words = np.unique(words)
    sought = key_first(words, mask)
    index = GrayIndex(sought)
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(words), QUERIES):
        q, m = index.within(sought[start:start + QUERIES], most)
        keep = q + start < m
        left, right = np.concatenate([left, start + q[keep]]), np.concatenate([right, m[keep]])
        if len(left) > 1 << 20:                     # a spanning star says as much
            root = _roots(len(words), left, right)
            left = np.flatnonzero(root != np.arange(len(root)))
            right = root[left]
    root = _roots(len(words), left, right)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return words[moved], words[root[moved]]


def block_masks(count: int, most: int = MAX_BITS) -> list[int]:
    """Masks of which any two words within ``most`` bits agree on at least
    one: all choices of ``blocks - most`` out of ``blocks`` blocks. More words
    call for masks with more bits, so that keys stay small: the fewest blocks
    with which random words share a key with fewer than 64 others."""
    for blocks in range(most + 1, 13):
        if count / 2 ** (64 * (blocks - most) / blocks) <= 64:
            break
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    assert comb(blocks, most)
    return [sum(chosen) for chosen in combinations(parts, blocks - most)]


def links(words: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Links ``u, v`` that connect all of ``words`` (a written table with one
    row per distinct ``fp``) that are within reach of each other."""
    count = words.count()
    masks = block_masks(count, most)
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
                     for i, m in enumerate(masks)])
    keyed = words.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", F.xxhash64("k.mask", "k.value").alias("key"))
    # keys with more words than one task should compare: few rows, but no
    # proven number, so they are joined, not collected
    large = written(keyed.groupBy("key").count().where(F.col("count") > PART)
                    .select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts")), "simhash-large")
    parted = keyed.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda other: F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)))
    parted = parted.select("fp", "mask", F.explode(F.when(F.col("parts") == 1, F.array("key")).otherwise(pairs)).alias("key"))
    buckets = max(2, -(-count // BUCKET_ROWS))
    parted = parted.withColumn("bucket", F.pmod("key", F.lit(buckets)))

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        u, v = links_of_bucket(rows["fp"].to_numpy(np.int64).view(np.uint64), masks[key[0]], most)
        release_memory()
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return parted.select("fp", "mask", "bucket").groupBy("mask", "bucket").applyInPandas(search, "u long, v long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _named_components(found: DataFrame, most: int) -> DataFrame:
    """``fp, component_id`` from rows with ``doc_id, fp``."""
    words = written(found.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "words")
    stars = written(star_components(links(words, most)), "stars")
    rooted = words.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    smallest = written(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "component-ids")
    return written(rooted.join(smallest, "root").select("fp", "root", "component_id"), "components")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    found = written(fingerprints(docs, shingle), "fingerprints")
    return found.join(_named_components(found, most), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, columns as given."""
    # a copy with a number for each row: ids may be null or repeat
    number = fresh_name(docs, "row_number")
    kept = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = written(kept.select(quoted(number).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                F.xxhash64("text").alias("text_hash"), _fingerprint_of(F.col("text"), shingle).alias("fp")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "row")
    ranked = found.join(_named_components(found, most).select("fp", "root"), "fp").select("root", order.alias("place"))
    first = written(ranked.groupBy("root").agg(F.min("place").alias("first")), "group-firsts")
    dropped = written(found.select("row").join(first.select(F.col("first.row").alias("row")), "row", "left_anti"), "dropped")
    return kept.join(dropped.withColumnRenamed("row", number), number, "left_anti").select(*[quoted(c) for c in docs.columns])
