from corvid.streaming.folder_stream import (
    await_query,
    batch_counts,
    hot_words,
    period_totals,
    period_word_counts,
    stage_lines_by_period,
    start_batch_word_counts,
    text_stream,
)
from corvid.streaming.windows import (
    compact,
    flatten_window,
    latest_windows,
    pane_aggregate,
    start_append,
    start_update,
    table_stream,
    windowed_aggregate,
    windows_of_panes,
)

__all__ = [
    "await_query",
    "batch_counts",
    "compact",
    "flatten_window",
    "hot_words",
    "latest_windows",
    "pane_aggregate",
    "period_totals",
    "period_word_counts",
    "stage_lines_by_period",
    "start_append",
    "start_batch_word_counts",
    "start_update",
    "table_stream",
    "text_stream",
    "windowed_aggregate",
    "windows_of_panes",
]
