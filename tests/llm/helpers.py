"""Small tables and a plain reading of words for the brute-force versions."""

import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")

AWKWARD = [
    (0, "The cat sat on the mat. The cat sat on the mat."),
    (1, ""),
    (2, None),
    (3, "The cat sat on the mat. The cat sat on the mat."),
    (4, "  \t\n"),
    (5, "one"),
    (6, "ÄÖÜ ßtraße naïve café ... 123 ½ x² don't I'LL we've"),
    (7, "日本語 テキスト ΑΣ Σ Σας ffi ﬁ İstanbul é"),
    (8, "word " * 5000),
    (9, "a\x00b\x1fc\x85d\xa0e"),
    (3, "The cat sat on the mat. The cat sat on the mat."),
    (None, "a row without an id but with text"),
]


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, extra=True):
    """``documents``-like rows; with clashing and extra columns."""
    schema = "doc_id long, text string"
    if not extra:
        return spark.createDataFrame(rows, schema)
    full = [(d, t, None, "src", 7, 1, "x") for d, t in rows]
    return spark.createDataFrame(full, schema + ", lang string, source string, count long, key int, value string")
