"""Column functions: text rules, timestamps, guarded arithmetic."""

from siltstone.functions.numeric import approval_rate, pct, ratio, vote_total
from siltstone.functions.temporal import days_between, month_of, parse_ts
from siltstone.functions.text import (
    any_contains,
    flag,
    has_token,
    label_ladder,
    link_key,
    lowered_text,
    matches_any,
    nested_contains,
    repo_name,
    repo_owner,
)

__all__ = [
    "any_contains", "approval_rate", "days_between", "flag", "has_token",
    "label_ladder", "link_key", "lowered_text", "matches_any", "month_of",
    "nested_contains", "parse_ts", "pct", "ratio", "repo_name", "repo_owner",
    "vote_total",
]
