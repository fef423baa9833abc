import hashlib
import random
import zlib

import duckdb
import pytest

from corvid.llm import queries, turn_trie


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    """The trie as defined, one conversation after the other."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role, text))
    turns = {c: [(t[3], t[4]) for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt = turns.get(c - c % 5, [])[:h] + own[h:]
        for d in range(len(rebuilt) + 1):
            members.setdefault(tuple(rebuilt[:d]), []).append(c)
        ends.setdefault(tuple(rebuilt), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items())


def found(frame):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in frame.collect())


SCHEMA = "conv_id long, turn long, role string, text string, id long, parent long, part int, kids string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)


def test_whole_table_meets_a_plain_version_and_sql(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(queries.op13_conversation_trie(spark, sf_dir))
    assert got == plain(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    sql = con.execute(queries.ORACLES["op13_conversation_trie"]).fetchall()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in sql) == got


def test_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "ä日", "", None])) for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(7, 3, "user", "again"), (7, 3, "user", "again"), (7, None, None, None), (None, 1, "user", "lost"), (200, 1, "user", "no base"),
             (61, 5, "ab", "c"), (62, 5, "a", "bc"), (0, -4, "user", "x" * 200_000)]
    rows += rows[:5]
    assert found(turn_trie.prefix_trie(frame(spark, rows))) == plain(rows)
    empty = turn_trie.prefix_trie(frame(spark, rows).where("false"))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"


def test_long_and_common_conversations(spark):
    """One conversation of a third of all rows, and many that are equal."""
    rows = [(1000, t, "user", str(t)) for t in range(700)]
    rows += [(5 * c, t, "user", "same") for c in range(1, 150) for t in range(3)]
    rows += [(c * 5 + 1, t, "user", f"{c} {t}") for c in range(1, 150) for t in range(3)]
    assert found(turn_trie.prefix_trie(frame(spark, rows).repartition(5))) == plain(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_contraction_of_any_tree(spark, shape):
    rng, size = random.Random(9), 400
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rng.randrange(i),
              "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2)}[shape]
    tree = [(0, None, 5, 1)] + [(i, parent(i), rng.randint(-9, 9), 1) for i in range(1, size)]
    a, b = {r[0]: r[2] for r in tree}, {r[0]: 1 for r in tree}
    for i, up, _, _ in reversed(tree[1:]):
        a[up] += a[i]
        b[up] += b[i]
    got = turn_trie.subtree_totals(spark.createDataFrame(tree, "id long, parent long, weight long, one long"), ["weight", "one"])
    assert {r.id: (r.weight, r.one) for r in got.collect()} == {i: (a[i], b[i]) for i in a}


def test_digests_reach_over_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "CHUNK_IDS", 7)
    ends = [(n, c) for n in range(4) for c in range(1, 100 * n + 2)]
    random.Random(1).shuffle(ends)
    got = {r.node: r.ends_sha256 for r in turn_trie.id_digests(spark.createDataFrame(ends, "node long, conv_id long")).collect()}
    for n in range(4):
        ids = sorted(c for m, c in ends if m == n)
        assert got[n] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
