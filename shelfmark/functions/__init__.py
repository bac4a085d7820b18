"""Column functions; all compose built-in expressions."""

from .clock import (
    refresh_text,
    refresh_text_at,
    time_of_day_from_interval,
    time_of_day_from_text,
)
from .documents import nested
from .numbers import double_to_text, in_long_range, int_or_default, is_whole
from .text import (
    bucket_of,
    destination_kind,
    first_segment,
    object_path,
    parent_path,
    without_prefix,
    without_spaces,
    without_trailing_slashes,
)

__all__ = [
    "bucket_of", "destination_kind", "double_to_text", "first_segment", "in_long_range",
    "int_or_default", "is_whole", "nested", "object_path", "parent_path", "refresh_text",
    "refresh_text_at", "time_of_day_from_interval", "time_of_day_from_text",
    "without_prefix", "without_spaces", "without_trailing_slashes",
]
