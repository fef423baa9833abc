import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corvid.llm import bpe, queries
from tests.llm.helpers import AWKWARD, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(bpe.load_vocabulary(PATH))


def plain_merges(symbols, ranks):
    """Byte-pair encoding as defined: the first merge that applies, leftmost."""
    parts = list(symbols)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_small_random_merge_lists_meet_plain_encoding():
    rng = random.Random(7)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 14)):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        ranks = {m: i for i, m in enumerate(merges)}
        gadgets = bpe.compile_merges(tokens, merges)
        made = bpe.Automaton.__new__(bpe.Automaton)
        made.gadgets, made.end, made.steps = gadgets, "", {}
        made.ids = {t: i for i, t in enumerate(tokens) if gadgets["alive"][i]}
        made.table = bpe.prefix_table(made.ids, "")
        for _ in range(40):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
            assert [tokens[i] for i in made.encode_symbols(word)] == plain_merges(word, ranks), (merges, word)


def test_words_have_exactly_one_path(automaton):
    """At every position one arc, and one only, leaves the state at its start."""
    for word in ("constantinople", "aaaaaaaaa", "abracadabra", "ththththe"):
        token = [-1] * (len(word) + 1)
        for stop in range(1, len(word) + 1):
            mark = automaton.end if stop == len(word) else ""
            found = [automaton.ids[word[at:stop] + mark] for at in range(stop)
                     if word[at:stop] + mark in automaton.ids and automaton.step(token[at], automaton.ids[word[at:stop] + mark])]
            assert len(found) == 1
            token[stop] = found[0]


def test_whole_texts_meet_the_library(spark, sf_dir):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in queries.op11_bpe_automaton(spark, sf_dir).collect():
        ids = library.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_rows(spark):
    library = Tokenizer.from_file(PATH)
    more = [(20, "a <|endoftext|> b <|startoftext|><|endoftext|>"), (21, "x" * 40_000), (22, "<|ENDOFTEXT|> o'clock they'll"),
            (23, "Ǆ ŉ é ẞ 　 \U0001f600 ١٢"), (24, "日本語 <|endoftext|> naïve")]
    rows = AWKWARD + more
    docs = frame(spark, rows)
    found = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    key = repr
    assert sorted(map(key, ((r.doc_id, r.token_ids, r.decoded) for r in found))) == sorted(map(key, expected))
    assert bpe.round_trip_digest(docs.where("false"), PATH).count() == 0


def test_decode_keeps_columns_and_passes_over_unknown_ids(spark):
    ids = spark.createDataFrame([(1, [320, 10**6, -1], "x"), (2, None, "y"), (3, [], "z")], "key int, token_ids array<int>, decoded_by string")
    found = {r.key: (r.decoded, r.decoded_by) for r in bpe.decode_documents(ids, PATH).collect()}
    assert found == {1: (Tokenizer.from_file(PATH).id_to_token(320), "x"), 2: ("", "y"), 3: ("", "z")}


def test_long_text(automaton):
    text = "the quick brown fox " * 200_000                 # 4 MB
    assert len(automaton.encode(text)) // 4 == 800_000


def test_improper_merges_are_refused():
    with pytest.raises(ValueError):
        bpe.compile_merges(["a", "b", "ab", "aab"], [("a", "ab"), ("a", "b")])
