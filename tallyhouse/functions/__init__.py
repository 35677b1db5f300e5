"""Column expressions."""

from tallyhouse.functions.scalars import (
    event_date,
    hour_of_day,
    infer_language,
    json_texts,
    last_path_part,
    short_repo_label,
    split_repo,
    type_filter,
)

__all__ = [
    "event_date",
    "hour_of_day",
    "infer_language",
    "json_texts",
    "last_path_part",
    "short_repo_label",
    "split_repo",
    "type_filter",
]
