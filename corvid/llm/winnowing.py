"""Document fingerprints by winnowing, in DataFrame functions only.

Every ``gram`` consecutive words are hashed; of every ``window`` consecutive
hashes the smallest is kept, the rightmost of equal ones, with its position.
Two texts that share ``window + gram - 1`` consecutive words have a
fingerprint in common, and the positions say where. Likeness is the share of
the two texts' distinct hashes that both have.

Hash and reversed position are packed into one long, so that the smallest
value of a window is the smallest hash at its rightmost position.

Defined results: a null text is an empty one and has no fingerprint; a text
of fewer words than a gram has one hash of all its words. Two texts without
hashes have likeness 1. Rows without an id follow all others, rows that
repeat an id follow each other in the order of their texts. Extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import total_bytes

GRAM = 5
WINDOW = 16
POSITION_BITS = 28      # more words than a string can hold
_LAST_POSITION = (1 << POSITION_BITS) - 1
BLOCK_BYTES = 4 << 20
# Bounds between blocks of ids that the driver asks a quantile sketch for.
MAX_BLOCKS = 4096
_COARSE = 64


def with_marks(df: DataFrame, text: str, marks: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add ``marks``: the packed fingerprints of column ``text`` in order.

    Steps are separate columns, each used more than once, so that none is
    worked out anew for each position."""
    words, hashes, grams = (f"_{marks}_{x}" for x in ("words", "hashes", "grams"))
    step1 = df.withColumn(words, F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    step2 = step1.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    count = F.greatest(F.size(hashes) - gram + 1, F.lit(1))
    packed = F.transform(F.sequence(F.lit(1), count), lambda i: F.shiftleft(
        F.shiftrightunsigned(F.xxhash64(F.slice(hashes, i, gram)), POSITION_BITS + 1), POSITION_BITS).bitwiseOR(
        F.lit(_LAST_POSITION).cast("long") - i.cast("long") + 1))
    none = F.array().cast("array<long>")
    step3 = step2.withColumn(grams, F.when(F.size(hashes) > 0, packed).otherwise(none))
    spans = F.greatest(F.size(grams) - window + 1, F.lit(1))
    least = F.transform(F.sequence(F.lit(1), spans), lambda i: F.array_min(F.slice(grams, i, window)))
    step4 = step3.withColumn(marks, F.when(F.size(grams) > 0, F.array_distinct(least)).otherwise(none))
    return step4.drop(words, hashes, grams)


def mark_hash(mark: Column) -> Column:
    return F.shiftright(mark, POSITION_BITS)


def mark_position(mark: Column) -> Column:
    """Word position, from 0, where the mark's gram begins."""
    return F.lit(_LAST_POSITION).cast("long") - mark.bitwiseAND(F.lit(_LAST_POSITION).cast("long"))


def written_out(marks: str) -> Column:
    """``hash@position`` of each fingerprint, hash in hexadecimal."""
    return F.array_join(F.transform(marks, lambda m: F.concat(
        F.lower(F.hex(mark_hash(m))), F.lit("@"), mark_position(m).cast("string"))), " ")


def hash_set(marks: str) -> Column:
    return F.array_distinct(F.transform(marks, mark_hash))


def likeness(a: str, b: str) -> Column:
    """Of two columns of distinct hashes: shared over all."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def _block_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below the id, by a coarse and a
    fine comparison; ids that are null come after all."""
    if not bounds:
        return F.when(doc_id.isNull(), 1).otherwise(0)
    whole = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(int(b)).cast("long") for b in bounds[::_COARSE]])
    skipped = F.greatest(F.size(F.filter(coarse, lambda b: b < doc_id)) - 1, F.lit(0)) * _COARSE
    inside = F.size(F.filter(F.slice(whole, skipped + 1, _COARSE), lambda b: b < doc_id))
    return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(skipped + inside)


def with_next(docs: DataFrame, columns: list[str], derived=lambda rows: rows,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``derived(docs)`` with ``next_<column>`` of the row that follows by
    ascending ``doc_id`` (after the last: the first).

    Rows are dealt into ranges of ids of about ``block_bytes`` each by
    quantiles of the ids, so no task orders all of them; the last row of a
    range takes the first of the next from a table of one row per range."""
    blocks = min(MAX_BLOCKS, max(1, -(-total_bytes(docs, "text") // block_bytes)))
    asked = [i / blocks for i in range(1, blocks)]
    found = docs.agg(F.percentile_approx("doc_id", asked, 10 * MAX_BLOCKS)).first()[0] if asked else []
    dealt = docs.withColumn("_block", _block_of(F.col("doc_id"), sorted(set(found or []))))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    least = dealt.groupBy("_block").agg(F.min("doc_id").alias("_least"))
    # the first row of each range: few rows, found by id before texts are read
    first = (dealt.join(F.broadcast(least.withColumnRenamed("_block", "_of")),     # at most MAX_BLOCKS + 1 rows
                        (F.col("_block") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_least")))
             .withColumn("_row", F.row_number().over(Window.partitionBy("_block").orderBy(*order)))
             .where("_row = 1").select("_block", "doc_id", "text"))
    first, dealt = derived(first), derived(dealt)
    ranges = Window.orderBy("_block")
    every = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = first.select("_block", *[
        F.coalesce(F.lead(F.struct(c)).over(ranges), F.first(F.struct(c)).over(every))[c].alias(f"_head_{c}")
        for c in columns])
    inside = Window.partitionBy("_block").orderBy(*order)
    led = dealt.select("*", *[F.lead(F.struct(c)).over(inside).alias(f"_next_{c}") for c in columns])
    joined = led.join(following, "_block")
    return joined.select(*docs.columns, *[c for c in columns if c not in docs.columns], *[
        F.when(F.col(f"_next_{c}").isNull(), F.col(f"_head_{c}")).otherwise(F.col(f"_next_{c}")[c]).alias(f"next_{c}")
        for c in columns])


def edited_pairs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprints of every document and of its edited text (the last half
    replaced by as much of the next document's beginning), with likenesses."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, ["text", "marks"], lambda r: with_marks(r, "text", "marks", gram, window), block_bytes)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (rows.withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                           F.substring("next_text", F.lit(1), half)))
            .select("doc_id", "n_chars", "edited", "marks", "next_marks"))
    rows = with_marks(rows, "edited", "edited_marks", gram, window)
    rows = rows.select("doc_id", "n_chars", "edited", "marks", "edited_marks", hash_set("marks").alias("own"),
                       hash_set("edited_marks").alias("other"), hash_set("next_marks").alias("following"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written_out("marks").alias("fingerprint"), written_out("edited_marks").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"), likeness("own", "following").alias("near_next"))


def matches(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per fingerprint: ``doc_id, hash, position``, for joins between
    corpora."""
    rows = with_marks(docs.select("doc_id", "text"), "text", "marks", gram, window)
    return rows.select("doc_id", F.explode("marks").alias("m")).select(
        "doc_id", mark_hash(F.col("m")).alias("hash"), mark_position(F.col("m")).alias("position"))
