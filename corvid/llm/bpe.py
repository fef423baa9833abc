"""BPE encoding and decoding by a tokenization automaton.

The automaton's arcs are tokens, and it accepts exactly the token sequences
that byte-pair encoding gives. It starts as one state with an arc for every
base symbol. Each merge (u, v), in order, adds a gadget: the state that u's
arcs lead to is copied without its arc v, u's arcs are led to the copy, and
wherever u then v could be read, one arc for the new token reads both and
ends where v's arcs end. All arcs of one token end in one state, so the copy
is a record of one removed arc, and a state is those records and the state
its token's right part had when the token was made; ``Automaton.step`` tells
from them whether a state has an arc and keeps what it found in a bounded
transition table. A merge whose v arc is already gone can never apply and
adds nothing.

A word has one accepted path, and so has every prefix of it: a word is
encoded from left to right along arcs that the table has, the longest token
first, and no position is come to twice. Decoding emits the arcs' labels.

Texts are cut into words as the vocabulary's file says (by its normalizer
and pre-tokenizer; texts in Latin-1 by the same pattern in Python), and each
distinct word is encoded once per worker while the bounded cache holds it.
The compiled gadgets are broadcast; their size is that of the vocabulary.

Defined results: null and empty texts, and texts of white space, have no
tokens and decode to the empty text. An added token's string in a text gives
its id. Repeated rows are encoded as often as they occur; null ids are kept;
extra columns are not read. Vocabularies that make one token by two merges,
or use a token before it is made, are refused with an error.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import release_memory
from corvid.llm.packing import _byte_characters, _latin_word_pattern

# Words and transitions a worker remembers; a full table is emptied.
CACHE_WORDS = 300_000
CACHE_STEPS = 1_000_000
# Text bytes of one output batch.
BATCH_BYTES = 4 << 20
_NEVER = 1 << 40
_SHIFT = 32


def compile_merges(tokens: list[str], merges: list[tuple[str, str]]) -> dict:
    """The gadgets of ``merges`` in order, as plain lists and a dictionary.

    ``removed`` maps (token u, token v) to the merge that took the arc v from
    the state after u; ``left``, ``right`` and ``born`` describe how a token
    was made (base symbols: -1), ``alive`` whether any arc reads it."""
    ids = {t: i for i, t in enumerate(tokens)}
    count = len(tokens)
    gadgets = {"left": [-1] * count, "right": [-1] * count, "born": [-1] * count, "alive": [True] * count, "removed": {}}
    left, right, born, alive, removed = (gadgets[k] for k in ("left", "right", "born", "alive", "removed"))
    made = {ids[a + b] for a, b in merges}
    ready = [i not in made for i in range(count)]
    for rank, (a, b) in enumerate(merges):
        u, v, token = ids[a], ids[b], ids[a + b]
        if ready[token] or not (ready[u] and ready[v]):
            raise ValueError(f"merge {rank} ({a} {b}): made twice, or of a token not yet made")
        ready[token] = True
        left[token], right[token], born[token] = u, v, rank
        alive[token] = alive[u] and alive[v] and has_arc(gadgets, u, v)
        if alive[token]:
            removed[u << _SHIFT | v] = rank
    return gadgets


def has_arc(gadgets: dict, state: int, token: int) -> bool:
    """Whether the state after the token ``state`` has the arc ``token``.

    The arc of a made token stands where its left part's arc stood when it
    was made, so the question is passed to left parts, of the copy that stood
    then, down to a base symbol, whose arc every state begins with."""
    left, right, born, removed = gadgets["left"], gadgets["right"], gadgets["born"], gadgets["removed"]
    limit = _NEVER
    while True:
        owner, until = state, limit
        while owner >= 0:
            rank = removed.get(owner << _SHIFT | token)
            if rank is not None and rank <= until:
                return False
            # the owner's state is a copy of its right part's, as it was then
            until = min(until, born[owner] - 1)
            owner = right[owner]
        if left[token] < 0:
            return True
        limit = born[token]
        token = left[token]


def load_vocabulary(path: str) -> dict:
    """A tokenizer file as plain data for the workers: tokens, gadgets, the
    word-end mark, added tokens and the file's text."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    model = spec["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or spec.get("decoder"):
        raise ValueError("a BPE vocabulary without dropout, continuation prefix and decoder is needed")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens must be plain strings")
    tokens = [""] * (max(model["vocab"].values()) + 1)
    for token, at in model["vocab"].items():
        tokens[at] = token
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"tokens": tokens, "gadgets": compile_merges(tokens, merges), "end": model.get("end_of_word_suffix") or "",
            "added": {t["content"]: t["id"] for t in spec["added_tokens"]}, "file": text}


def prefix_table(ids: dict[str, int], end: str) -> dict[str, int]:
    """Every prefix of a token without the word-end mark, with the token's id
    or -1 where the prefix is none."""
    plain = [t for t in ids if not end or not t.endswith(end)]
    table = {t[:n]: -1 for t in plain for n in range(1, len(t))}
    table.update((t, ids[t]) for t in plain)
    return table


class _Words(dict):
    """Ids of words already encoded; an unseen word is encoded when asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = self[word] = array("i", self.encode(word)).tobytes()
        return found


class Automaton:
    """Encodes words and texts by a loaded vocabulary."""

    def __init__(self, vocabulary: dict):
        from tokenizers import Tokenizer

        self.gadgets = vocabulary["gadgets"]
        self.end = vocabulary["end"]
        self.ids = {t: i for i, t in enumerate(vocabulary["tokens"]) if t and self.gadgets["alive"][i]}
        self.table = prefix_table(self.ids, self.end)
        self.added = vocabulary["added"]
        self.library = Tokenizer.from_str(vocabulary["file"])       # for splitting only
        self.find_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.find_words = _latin_word_pattern().findall
        self.byte_characters = _byte_characters()
        self.steps: dict[int, bool] = {}
        # by the word as it stands in a Latin-1 text, and by its byte characters
        self.latin = _Words(lambda word: self.encode_symbols(word.encode().decode("latin-1").translate(self.byte_characters)))
        self.symbols = _Words(self.encode_symbols)

    def step(self, state: int, token: int) -> bool:
        """The transition table: whether ``state`` (-1 at the start of a
        word) has the arc ``token``."""
        if state < 0:
            return True
        key = state << _SHIFT | token
        found = self.steps.get(key)
        if found is None:
            if len(self.steps) >= CACHE_STEPS:
                self.steps.clear()
            found = self.steps[key] = has_arc(self.gadgets, state, token)
        return found

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of one pre-split word, given as byte characters.

        Longer tokens are tried first. A position that leads nowhere is left
        for good: there is one accepted path to it only."""
        ids, end, table, size = self.ids, self.end, self.table, len(symbols)
        out: list[int] = []
        ways: list[tuple[int, list[tuple[int, int]]]] = []          # state and untried arcs of each token's start
        state, at = -1, 0
        while True:
            found = ids.get(symbols[at:] + end)
            if found is not None and self.step(state, found):
                out.append(found)
                return out
            arcs = []
            for stop in range(at + 1, size):
                token = table.get(symbols[at:stop])
                if token is None:
                    break
                if token >= 0:
                    arcs.append((stop, token))
            ways.append((state, arcs))
            while True:
                state, arcs = ways[-1]
                while arcs:
                    at, token = arcs.pop()
                    if self.step(state, token):
                        break
                else:
                    ways.pop()
                    if not ways:
                        raise ValueError("a byte of the text is no base symbol of the vocabulary")
                    out.pop()
                    continue
                out.append(token)
                state = token
                break

    def _plain(self, text: str) -> bytes:
        for words in (self.latin, self.symbols):
            if len(words) > CACHE_WORDS:
                words.clear()
        lowered = text.lower()
        try:
            lowered.encode("latin-1")
        except UnicodeEncodeError:
            normal = self.library.normalizer.normalize_str(text)
            return b"".join([self.symbols[w] for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)])
        return b"".join(map(self.latin.__getitem__, self.find_words(lowered)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers."""
        if self.find_added is None or not self.find_added.search(text):
            return self._plain(text)
        parts = self.find_added.split(text)
        return b"".join(np.array([self.added[p]], "<i4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts))


def labels(vocabulary: dict) -> pa.Array:
    """The label of every id; null where the vocabulary has a gap."""
    names = [t or None for t in vocabulary["tokens"]]
    names += [None] * (max([len(names) - 1, *vocabulary["added"].values()]) + 1 - len(names))
    for name, at in vocabulary["added"].items():
        names[at] = name
    return pa.array(names, pa.large_string())


def _row_runs(sizes: list[int], limit: int):
    """Ranges of rows of about ``limit`` bytes each."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, token_ids`` of every row of ``docs`` (``doc_id``, ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def each(batches):
        automaton = Automaton(shared.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for first, last in _row_runs(sizes, BATCH_BYTES):
                rows = batch.slice(first, last - first)
                found = [automaton.encode(t.as_py() or "") for t in rows.column(1)]
                ends = np.cumsum([0] + [len(f) // 4 for f in found]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], names=["doc_id", "token_ids"])
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        each, "doc_id long, token_ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (any table with ``token_ids``) with the text its ids stand
    for as ``decoded``: the arcs' labels, joined by one space as the library
    does for a vocabulary without a decoder. Ids without a label are passed over."""
    shared = encoded.sparkSession.sparkContext.broadcast(labels(load_vocabulary(path)).to_pylist())
    at = encoded.columns.index("token_ids")

    def each(batches):
        names = pa.array(shared.value, pa.large_string())
        for batch in batches:
            lists = batch.column(at)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            for first, last in _row_runs(sizes, BATCH_BYTES // 4):
                rows = batch.slice(first, last - first)
                ids = rows.column(at)
                given = ids.fill_null([]) if ids.null_count else ids
                known = pc.and_(pc.greater_equal(given.flatten(), 0), pc.less(given.flatten(), len(names)))
                words = names.take(pc.if_else(known, given.flatten(), pa.scalar(None, pa.int32())))
                spans = np.append(0, np.cumsum(pc.list_value_length(given).to_numpy()))
                if words.null_count:
                    kept = pc.is_valid(words).to_numpy(zero_copy_only=False)
                    spans = np.append(0, np.cumsum(kept))[spans]
                    words = words.drop_null()
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(spans, pa.int32()), words), pa.scalar(" ", words.type))
                yield pa.RecordBatch.from_arrays([*rows.columns, joined.cast(pa.string())], names=[*batch.schema.names, "decoded"])
        release_memory()

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(each, f"{fields}, decoded string")


def round_trip_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: the number of its ids, and hashes of the ids (decimal,
    joined by one space) and of the text they decode to."""
    decoded = decode_documents(encode_documents(docs, path), path)
    return decoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
