"""Column-level helpers: casts, rule tables, guarded arithmetic, join sizing."""

from larder.functions.expressions import (
    first_match,
    guarded_ratio,
    lenient_int,
    lenient_long,
    regex_rule,
    substring_rule,
)
from larder.functions.sizing import dealt, estimated_bytes, join_small, task_count

__all__ = [
    "dealt",
    "estimated_bytes",
    "first_match",
    "guarded_ratio",
    "join_small",
    "lenient_int",
    "lenient_long",
    "regex_rule",
    "substring_rule",
    "task_count",
]
