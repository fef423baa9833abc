"""Scalar and generator expressions over strings (all JVM-side built-ins)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line ends recognised by Spark's text reader: CRLF, CR and LF.
LINE_BREAK = r"\r\n|\r|\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_keep_empty(c: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator and keep every token, empty ones included.

    Same result as Python's ``str.split(sep)``: ``"a  b "`` gives
    ``["a", "", "b", ""]``.
    """
    return F.split(_col(c), re.escape(sep), -1)


def split_lines(c: Column | str) -> Column:
    """The lines of a text value, as the text reader would cut them."""
    return F.split(_col(c), LINE_BREAK, -1)


def split_tokens_of_lines(c: Column | str, sep: str = " ") -> Column:
    """The tokens of all lines at once: cut at line ends and at a literal
    separator, every token kept, empty ones included.

    A single character joins the line ends' class, which matches faster than
    one more alternative."""
    pattern = rf"\r\n|[\r\n{re.escape(sep)}]" if len(sep) == 1 else f"{LINE_BREAK}|{re.escape(sep)}"
    return F.split(_col(c), pattern, -1)


def split_multivalue(c: Column | str, sep: str = "|") -> Column:
    """Split a delimited multi-value field (``"Action|Drama"``) into an array."""
    return F.split(_col(c), re.escape(sep), -1)


def path_segment(c: Column | str, position: int) -> Column:
    """Segment of a ``/``-separated path; negative positions count from the end."""
    return F.element_at(F.split(_col(c), "/", -1), position)


def csv_field(c: Column | str, index: int, sep: str = ",") -> Column:
    """Field ``index`` (0-based) of a delimited line, without quote handling."""
    return F.element_at(F.split(_col(c), re.escape(sep), -1), index + 1)


def like_label(c: Column | str, pattern: str) -> Column:
    """0.0 / 1.0 label from a LIKE predicate (null stays null)."""
    return _col(c).like(pattern).cast("double")
