from corvid.functions.text import (
    LINE_BREAK,
    csv_field,
    like_label,
    path_segment,
    split_keep_empty,
    split_lines,
    split_multivalue,
)

__all__ = [
    "LINE_BREAK",
    "csv_field",
    "like_label",
    "path_segment",
    "split_keep_empty",
    "split_lines",
    "split_multivalue",
]
