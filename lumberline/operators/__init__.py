"""DataFrame in, DataFrame out."""

from lumberline.operators.metrics import (
    count_by_id,
    count_per_day,
    counts_by_level_and_id,
    level_timeseries,
    share_by_id,
    trend_by_day_and_level,
)
from lumberline.operators.parse import (
    drop_unparsed,
    ensure_event_time,
    parse_log_lines,
    parse_logs,
    to_json_rows,
    with_event_time,
)
from lumberline.operators.shape import (
    drop_levels,
    filter_level,
    filter_time_range,
    select_log_columns,
)
from lumberline.operators.timejoin import as_of_join, band_join, interval_join, overlap_join

__all__ = [
    "as_of_join",
    "band_join",
    "count_by_id",
    "count_per_day",
    "counts_by_level_and_id",
    "drop_levels",
    "drop_unparsed",
    "ensure_event_time",
    "filter_level",
    "filter_time_range",
    "interval_join",
    "level_timeseries",
    "overlap_join",
    "parse_log_lines",
    "parse_logs",
    "select_log_columns",
    "share_by_id",
    "to_json_rows",
    "trend_by_day_and_level",
    "with_event_time",
]
