"""The pipeline, stage by stage, against the brute-force versions."""

import tempfile

import corpus_pipeline
import public_tokenizers
import pytest
import test_decontaminate as leaks
import test_packing as pieces
import test_simhash as near
import test_substring as repeats
from helpers import lower_ascii, words
from tokenizers import Tokenizer

from corvid.llm import langid, simhash
from corvid.llm.common import written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture_rows():
    docs, items = leaks.corpus(7)
    rows = [(d, t) for d, t in docs if d is not None]
    rows += [(200 + d, t) for d, t in repeats.corpus(8) if d is not None]
    rows += [(9000, rows[5][1]), (9001, rows[5][1]), (9002, "123 456"), (9003, None)]
    seen, out = set(), []
    for d, t in rows:
        if d not in seen:
            seen.add(d)
            out.append((d, t, "en" if d % 3 else None, "src", len(t or "")))
    return out, items


def fingerprint(text):
    return simhash.fingerprint([w.encode() for w in words(lower_ascii(text or ""))])


def test_stages_one_by_one(spark):
    rows, items = fixture_rows()
    folder = tempfile.mkdtemp(prefix="corvid-pipeline-")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    leaks.items_frame(spark, items).select("item_id", "text").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "stage")
        got[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.dtypes == [tuple(f.split()) if " " in f else f for f in
                                   [x.replace("long", "bigint") for x in SCHEMA.split(", ")]]

    kept = [r for r in rows if langid.words_of(r[1] or "")]
    assert sorted(tuple(r)[:2] for r in got["language id"]) == sorted(r[:2] for r in kept)
    assert {r.lang for r in got["language id"]} == {"en"}                    # the one language learned fills the nulls
    kept = [(*r[:2], "en", *r[3:]) for r in kept]

    comps = dict(near.brute_groups([(r[0], fingerprint(r[1])) for r in kept]))
    kept = [r for r in kept if comps[r[0]] == r[0]]
    assert sorted(map(tuple, got["simhash near-dedup"])) == sorted(kept, key=lambda r: r[0])

    digests = {d: (removed, sha) for d, _, removed, sha in repeats.brute([r[:2] for r in kept], 20)}
    cut = {r.doc_id: r for r in got["substring dedup"]}
    for r in kept:
        removed, sha = digests[r[0]]
        if not removed:
            assert tuple(cut[r[0]]) == r
        elif removed < len(words(r[1])):
            assert repeats.hashlib.sha256(cut[r[0]].text.encode()).hexdigest() == sha
            assert cut[r[0]].n_chars == len(cut[r[0]].text)
        else:
            assert r[0] not in cut
    assert any(d[0] for d in digests.values())

    found = {d for d, _ in leaks.brute_leaks([(r.doc_id, r.text) for r in cut.values()], items, least_words=2)}
    kept = {d: r for d, r in cut.items() if d not in found}
    assert {r.doc_id: r for r in got["benchmark decontamination"]} == kept and found

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = []
    for r in kept.values():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1
        lengths += [min(2048, n - at) for at in range(0, n, 2048)]
    packed = got["best-fit packing"]
    assert sorted(r.length for r in packed) == sorted(lengths)
    assert len({r.sequence_id for r in packed}) == len(pieces.brute_best_fit(lengths, 2048))


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_empty_documents(spark):
    folder = tempfile.mkdtemp(prefix="corvid-pipeline-")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names_are_usable_as_folders(name):
    assert name.replace(" ", "-").replace("-", "").isalnum()
