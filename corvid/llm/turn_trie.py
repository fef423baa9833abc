"""Conversation prefix trie, its subtree totals by parallel tree contraction.

``number_turns`` orders the turns of every conversation without holding one
conversation in a task: rows are range-partitioned by conversation and turn,
numbered inside partitions, and a conversation's partitions are offset by the
rows before them. ``rebuild`` gives each conversation the head of another one.
A prefix of turns is named by two 64-bit hashes, each the exclusive-or of
hashes of (position, turn) over the prefix, so prefixes are running sums that
partitions compute side by side. Conversations of equal prefix meet in one
trie node.

``subtree_totals`` contracts the trie in rounds of joins. A round rakes all
leaves into their parents, then compresses: of the nodes with a single child,
those that a hash of id and round picks (never two neighbours) are spliced
out, and the child takes over the value they add above. Chains and bushes both
shrink by a constant share a round, so a trie of any depth takes rounds
logarithmic in its size. A raked node's total is known; a spliced node's is
its child's plus what was noted, and following those notes by doubling
re-expands all of them in a few joins.

Defined results: rows of null ``conv_id`` belong to no conversation and are
left out. Turns go by ``turn``, null first; rows of equal turn by a hash of
role and text (so repeated rows stay side by side). Null role and text are
empty. Conversations without rebuilt turns end at the root, an empty table has
no node. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import written

# Longest head taken over from another conversation.
HEAD_MODULUS = 9
GROUP = 5
# Rows that a range of turns, and a chunk of ids to be hashed, holds.
RANGE_ROWS = 500_000
CHUNK_IDS = 4096


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, part, t1, t2, bytes``: every turn with its place (from
    1), the range it was sorted in, two hashes of role and text, and the text's
    UTF-8 bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the role's length keeps role and text apart
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.sha2(whole, 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    turns = written(turns, "turns")
    ranges = max(8, -(-turns.count() // RANGE_ROWS))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    dealt = written(turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                    .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "turns-sorted")
    spans = dealt.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    # a conversation has a row for each range it reaches into
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    spans = written(spans.select("conv_id", "part", (before - F.col("first") + 1).alias("shift")), "turn-spans")
    return written(dealt.join(spans, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") + F.col("shift")).alias("at"), "part",
        F.xxhash64(F.lit(1), "digest").alias("t1"), F.xxhash64(F.lit(2), F.reverse("digest")).alias("t2"), "bytes"), "turns-numbered")


def head_length() -> Column:
    """Turns taken from the group's first conversation."""
    return F.crc32(F.col("conv_id").cast("string")) % HEAD_MODULUS


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first turns of its group's first one in
    front of its own later ones: ``conv_id, at, part, t1, t2, bytes`` (part -1:
    the head), and ``conv_id, head`` of all conversations."""
    heads = turns.where(F.col("at") < HEAD_MODULUS).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "t1", "t2", "bytes"))).alias("turns"))       # fewer than HEAD_MODULUS
    convs = turns.select("conv_id").distinct().withColumn("h", head_length()).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % GROUP)
    found = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "h", F.coalesce(F.slice("turns", 1, F.col("h").cast("int")), F.array().cast(heads.schema["turns"].dataType)).alias("turns"))
    found = written(found.withColumn("head", F.size("turns").cast("long")), "heads")
    front = found.select("conv_id", F.explode("turns").alias("x")).select(
        "conv_id", F.col("x.at").alias("at"), F.lit(-1).alias("part"), "x.t1", "x.t2", "x.bytes")
    own = turns.join(found.select("conv_id", "h", "head"), "conv_id").where(F.col("at") > F.col("h")).select(
        "conv_id", (F.col("at") - F.col("h") + F.col("head")).alias("at"), "part", "t1", "t2", "bytes")
    return written(front.unionByName(own), "rebuilt"), found.select("conv_id", "head")


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, bytes``: the names of every prefix
    and of the prefix before it."""
    placed = rebuilt.select("conv_id", "part", F.col("at").alias("depth"), F.xxhash64("at", "t1").alias("h1"),
                            F.xxhash64("at", "t2").alias("h2"), "bytes")
    running = Window.partitionBy("conv_id", "part").orderBy("depth")
    inner = placed.select("*", F.bit_xor("h1").over(running).alias("r1"), F.bit_xor("h2").over(running).alias("r2"))
    inner = written(inner, "prefixes-inner")
    ends = inner.groupBy("conv_id", "part").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(ends.select("conv_id", "part", *(F.coalesce(F.bit_xor(s).over(earlier), F.lit(0).cast("long")).alias(o)
                                                       for s, o in (("s1", "o1"), ("s2", "o2")))), "prefix-offsets")
    whole = inner.join(offsets, ["conv_id", "part"])
    k1, k2 = F.col("r1").bitwiseXOR(F.col("o1")), F.col("r2").bitwiseXOR(F.col("o2"))
    return written(whole.select("conv_id", "depth", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("h1")).alias("p1"),
                                k2.bitwiseXOR(F.col("h2")).alias("p2"), "bytes"), "prefixes")


def trie_nodes(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``id, parent, depth, conv_id, n_convs, bytes, k1, k2``: the root (no
    parent) and a node for every distinct prefix."""
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), "conv_id", "n_convs", zero.alias("bytes"))
    below = rows.groupBy("depth", "k1", "k2").agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes"))
    nodes = written(root.unionByName(below).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
                         F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    return written(nodes.join(above, ["depth", "p1", "p2"], "left").select(
        "id", "parent", "parent_conv_id", "depth", "conv_id", "n_convs", "bytes", "k1", "k2"), "trie")


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and, for each of ``values`` (long columns of ``tree``: ``id,
    parent, ...``; a root has a null parent), its sum over the node's subtree."""
    own, edge, note = ([f"{p}{i}" for i in range(len(values))] for p in ("own", "edge", "note"))
    nothing = F.lit(0).cast("long")
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"))
    # own: what is known to belong to the node; edge: what its parent gets besides its total
    active = written(tree.join(kids, "id", "left").select(
        "id", "parent", F.coalesce("kids", nothing).alias("kids"),
        *(F.col(v).alias(o) for v, o in zip(values, own, strict=True)), *(nothing.alias(e) for e in edge)), "contract")
    notes, rounds = [], 0
    while active.limit(1).count():
        rounds += 1
        # rake: leaves are finished and go into their parents
        leaf = F.col("kids") == 0
        notes.append(active.where(leaf).select("id", F.lit(None).cast("long").alias("next"),
                                               *(F.col(o).alias(n) for o, n in zip(own, note, strict=True))))
        raked = active.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count_if(~leaf).alias("now"), F.min(F.when(~leaf, F.col("id"))).alias("now_only"),
            *(F.sum(F.when(leaf, F.col(o) + F.col(e)).otherwise(0)).alias(f"add_{o}") for o, e in zip(own, edge, strict=True)))
        left = written(active.where(~leaf).join(raked, "id").select(
            "id", "parent", F.col("now").alias("kids"), F.col("now_only").alias("only"),
            *((F.col(o) + F.col(f"add_{o}")).alias(o) for o in own), *edge), "raked")
        # compress: nodes of one child, of which no two are neighbours, go out
        picked = F.pmod(F.xxhash64("id", F.lit(rounds)), F.lit(2)) == 1
        chain = left.where("kids = 1 and parent is not null")
        child = left.select(F.col("id").alias("only"), ((F.col("kids") == 1) & picked).alias("rival"),
                            *(F.col(e).alias(f"child_{e}") for e in edge))
        spliced = written(chain.where(picked).join(child, "only").where("not rival").select(
            "id", F.col("only").alias("next"), "parent", *own, *edge, *(f"child_{e}" for e in edge)), "spliced")
        notes.append(spliced.select("id", "next", *((F.col(o) + F.col(f"child_{e}")).alias(n)
                                                    for o, e, n in zip(own, edge, note, strict=True))))
        # what a splice says to the child that moves up, and to the node that goes
        news = spliced.select(F.col("next").alias("id"), F.col("parent").alias("new_parent"), F.lit(False).alias("gone"),
                              *((F.col(o) + F.col(e)).alias(f"add_{e}") for o, e in zip(own, edge, strict=True)))
        news = news.unionByName(spliced.select("id", F.lit(None).cast("long").alias("new_parent"), F.lit(True).alias("gone"),
                                               *(nothing.alias(f"add_{e}") for e in edge)))
        active = written(left.join(news, "id", "left").where("gone is null or not gone").select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "kids", *own,
            *((F.col(e) + F.coalesce(f"add_{e}", nothing)).alias(e) for e in edge)), "contract")
    return _expanded(notes, note, values) if notes else tree.select("id", *values)


def _expanded(notes: list[DataFrame], note: list[str], values: list[str]) -> DataFrame:
    """Totals from notes ``id, next, note...``: a node's total is its note
    plus the total of ``next``. Chains of notes are as long as there were
    rounds at most, and every pass halves them."""
    whole = notes[0]
    for more in notes[1:]:
        whole = whole.unionByName(more)
    whole = written(whole, "notes")
    while whole.where("next is not null").limit(1).count():
        ahead = whole.select(F.col("id").alias("next"), F.col("next").alias("then"), *(F.col(n).alias(f"then_{n}") for n in note))
        follow = whole.where("next is not null").join(ahead, "next").select(
            "id", F.col("then").alias("next"), *((F.col(n) + F.col(f"then_{n}")).alias(n) for n in note))
        whole = written(whole.where("next is null").unionByName(follow), "notes")
    return whole.select("id", *(F.col(n).alias(v) for n, v in zip(note, values, strict=True)))


def id_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of ``ends`` (``node, conv_id``): SHA-256 of a
    node's ids, ascending, in decimal, joined by commas.

    A hash reads its input in order, so one task hashes one node's ids; it
    gets them as joined chunks from a distributed sort, in order, and holds
    one chunk at a time."""
    total = ends.count()
    ranges = max(8, -(-total // RANGE_ROWS))

    def join_up(batches):
        for batch in batches:
            node, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, at = [], 0
            for i in range(1, len(node) + 1):
                if i == len(node) or node[i] != node[at] or i - at >= CHUNK_IDS:
                    rows.append((node[at], conv[at], ",".join(map(str, conv[at:i]))))
                    at = i
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                             names=["node", "first", "ids"])

    chunks = written(ends.repartitionByRange(ranges, "node", "conv_id").sortWithinPartitions("node", "conv_id").select(
        "node", "conv_id").mapInArrow(join_up, "node long, first long, ids string"), "id-chunks")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if state is not None and n == node:
                    state.update(b",")
                else:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256()
                state.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.string()))],
                                             names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    rebuilt, convs = rebuild(number_turns(conversations))
    rows = prefixes(rebuilt)
    nodes = trie_nodes(rows, convs)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    described = written(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
                        "trie-described")
    totals = subtree_totals(described.select(
        "id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    # a conversation ends at its deepest prefix, one without turns at the root
    deepest = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    zero = F.lit(0).cast("long")
    last = convs.select("conv_id").join(deepest, "conv_id", "left").withColumn("depth", F.coalesce("depth", zero))
    last = last.join(rows.select("conv_id", "depth", "k1", "k2"), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("k1", zero).alias("k1"), F.coalesce("k2", zero).alias("k2"))
    ends = written(last.join(nodes.select("depth", "k1", "k2", F.col("id").alias("node")), ["depth", "k1", "k2"])
                   .select("node", "conv_id"), "trie-ends")
    digests = id_digests(ends).withColumnRenamed("node", "id")
    nobody = hashlib.sha256(b"").hexdigest()
    return described.join(totals, "id").join(digests, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))
