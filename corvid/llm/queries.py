"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from corvid.llm import bpe, decontaminate, langid, licences, packing, pagediff, ppm, simhash, substring, turn_trie, warc, whitening, winnowing
from corvid.session import table


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_ppm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ppm.score_documents(docs, ppm.held_out_fold())


def op2_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op3_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, _tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_all_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))


def op5_licence_scan(spark, sf_dir):
    return licences.find_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicate_groups(docs)


def op7_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.kept_digest(substring.remove_repeats(docs))


def op8_warc(spark, sf_dir):
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_archives(manifest, keep_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_page_differencing(spark, sf_dir):
    return pagediff.extract(table(spark, sf_dir, "pages"))


def op10_winnowing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnowing.edited_pairs(docs)


def op11_bpe_automaton(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digest(docs, _tokenizer_path())


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark, sf_dir):
    return turn_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_ppm_scoring": op1_ppm_scoring,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_licence_scan": op5_licence_scan,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_warc": op8_warc,
    "op9_page_differencing": op9_page_differencing,
    "op10_winnowing": op10_winnowing,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_conversation_trie": op13_conversation_trie,
}

# The others have no SQL form (tokenizers, XXH64, fitted models).
ORACLES: dict[str, str] = {
    "op7_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, s + j AS p FROM later, range(0, 20) AS r(j)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '') AS kept
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
""",
    "op8_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST('0x' || substr(p.h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31)
         AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h
""",
    # these pages mark their articles, whose blocks are headings and paragraphs
    "op9_page_differencing": r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(b|br)>', ' ', 'g') AS inner_html
  FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(inner_html, '</?(p|h1)>'), lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'),
    '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text,
       CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars
FROM b
""",
    # a prefix is the string of its turns' hashes; crc32 is spelled out bit by bit
    "op13_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, strlen(coalesce(text, '')) AS bytes,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295, list_transform(
    range(1, strlen(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i:
      CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS head
  FROM (SELECT DISTINCT conv_id FROM t)),
front AS (SELECT c.conv_id, t.place, t.bytes, t.h FROM c JOIN t ON t.conv_id = c.base AND t.place <= c.head),
n AS (SELECT conv_id, count(*) AS n FROM front GROUP BY conv_id),
r AS (
  SELECT * FROM front UNION ALL
  SELECT c.conv_id, t.place - c.head + coalesce(n.n, 0), t.bytes, t.h
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.head LEFT JOIN n ON n.conv_id = c.conv_id),
p AS (
  SELECT conv_id, CAST(place AS BIGINT) AS depth, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY place) AS k, bytes FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
node AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, k[:64 * (depth - 1)] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
known AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON node.depth = kids.depth AND node.k = kids.k),
up AS (
  SELECT d AS depth, k[:64 * d] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM known) GROUP BY 1, 2),
ends AS (
  SELECT depth, k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, depth, k FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY 1, 2)
SELECT known.conv_id, known.depth, above.conv_id AS parent_conv_id, known.n_convs, known.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM known JOIN up ON known.depth = up.depth AND known.k = up.k
LEFT JOIN node AS above ON above.depth = known.depth - 1 AND above.k = known.k[:64 * (known.depth - 1)]
LEFT JOIN ends ON ends.depth = known.depth AND ends.k = known.k
""",
}
