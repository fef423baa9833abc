"""Language identification: held-out accuracy, and scores against a plain
version of the backoff."""

import math
import random
from collections import Counter

import pytest
from helpers import AWKWARD

from corvid.llm import langid
from corvid.session import table

SCHEMA = "doc_id long, text string, lang string, score double, unit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "u") for r in rows], SCHEMA)


def labelled(seed=1, docs=120):
    rng = random.Random(seed)
    stems = {"aa": ["the", "ing", "of", "th"], "bb": ["sch", "ung", "der", "ß"], "cc": ["eau", "le", "é", "que"]}
    out = []
    for i in range(docs):
        lang = rng.choice(list(stems))
        out.append((i, " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 30))), lang))
    return out


def plain_score(rows, text):
    """The same sums by plain counting (tables not cut)."""
    langs = sorted({r[2] for r in rows})
    words = {lang: Counter(w for r in rows if r[2] == lang for w in langid.words_of(r[1])) for lang in langs}
    grams = {lang: Counter(g for w, n in words[lang].items() for s in range(1, 6) for g in langid.grams_of(w, s) for _ in range(n))
             for lang in langs}
    kinds = {"w": set().union(*words.values()), "g": set().union(*grams.values())}

    def log(counts, kind, unit):
        return [math.log((counts[x][unit] + 0.5) / (counts[x].total() + 0.5 * len(kinds[kind]))) for x in langs]

    total, n = [0.0] * len(langs), 0
    for w in langid.words_of(text):
        if w in kinds["w"]:
            part = log(words, "w", w)
        else:
            for size in range(5, 0, -1):
                known = [g for g in langid.grams_of(w, size) if g in kinds["g"] and g != " "]
                if known:
                    part = [sum(x) / len(known) for x in zip(*(log(grams, "g", g) for g in known), strict=True)]
                    break
            else:
                continue
        total, n = [a + b for a, b in zip(total, part, strict=True)], n + 1
    best = max(range(len(langs)), key=lambda i: total[i])
    return langs[best], 1 / sum(math.exp((t - total[best]) / math.sqrt(n)) for t in total)


def test_scores_equal_plain_counting(spark):
    rows = labelled()
    model = langid.train(frame(spark, rows))
    texts = [r[1] for r in rows[:30]] + ["thunder quella schleau", "zzthzz of", "the der le", "ÉAU!! 12", "unofth schquex"]
    scorer = langid.Scorer(model)
    for text in texts:
        got, want = scorer.predict(text), plain_score(rows, text)
        assert got[0] == want[0]
        assert got[1] == pytest.approx(want[1], rel=1e-9)


def test_defined_results(spark):
    rows = [*labelled(), (500, None, "aa"), (501, "no label the", None), (None, "the the", "aa")]
    asked = [(d, t, None) for d, t in AWKWARD] + [(70, "12 34 !!", "aa"), (72, "² ½", None), (71, "ж", None)]
    model = langid.train(frame(spark, rows))
    assert model.languages == ["aa", "bb", "cc"]
    got = langid.predict(frame(spark, asked), model).collect()
    assert len(got) == len(asked)
    text = {d: t for d, t, _ in asked}
    for r in got:
        if r.doc_id is not None and (not text[r.doc_id] or not any(c.isalpha() for c in text[r.doc_id])):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.languages and 0 < r.score <= 1
    assert [r.score for r in got if r.doc_id == 71] == [pytest.approx(1 / 3)]


def test_nothing_learned_and_empty_table(spark):
    model = langid.train(frame(spark, []))
    assert {r.lang_pred for r in langid.predict(frame(spark, [(1, "text", "aa")]), model).collect()} == {"und"}
    assert langid.identify(frame(spark, [])).count() == 0


def test_bounds_hold(spark):
    model = langid.train(frame(spark, labelled(docs=400)), max_documents=100, max_words=20, max_grams=30)
    assert len(model.words) <= 20 and len(model.grams) <= 30


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) / len(found) > 0.97


def test_filter_keeps_columns_and_clean_rows(spark):
    rows = [*labelled(), (900, "123 !!", "aa"), (901, None, "bb")]
    docs = frame(spark, rows)
    kept = langid.keep_identified(docs, langid.train(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in labelled()]


def test_filter_puts_the_prediction_into_lang(spark):
    learned = labelled()
    model = langid.train(frame(spark, learned))
    scorer = langid.Scorer(model)
    rows = [(1000 + d, t, None) for d, t, _ in learned] + [(2000 + d, t, "zz") for d, t, _ in learned] + [(3000, "!! 12", None)]
    docs = spark.createDataFrame([(d, t, g, 1, 2) for d, t, g in rows], "doc_id long, text string, lang string, `a.b` int, found_language int")
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns
    got = {r.doc_id: (r.lang, r["a.b"], r.found_language) for r in kept.collect()}
    want = {}
    for d, t, given in rows[:-1]:
        lang, score = scorer.predict(t)
        want[d] = (lang if given is None or score >= langid.CERTAIN else given, 1, 2)
    assert got == want and {w[0] for w in want.values()} >= {"aa", "bb"}


def test_filter_without_anything_learned_keeps_texts_with_a_letter(spark):
    rows = [(d, t, None) for d, t in AWKWARD] + [(70, "a", "xx"), (71, "12 !!", "xx")]
    kept = langid.keep_identified(frame(spark, rows), langid.train(frame(spark, [])))
    letters = [(d, g) for d, t, g in rows if t and any(c.isalpha() for c in t)]
    assert sorted(map(repr, ((r.doc_id, r.lang) for r in kept.collect()))) == sorted(map(repr, letters))
