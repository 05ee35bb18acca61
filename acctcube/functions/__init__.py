from acctcube.functions.columns import (
    apply_to,
    between,
    contains,
    ends_with,
    pick,
    rename_prefix,
    starts_with,
    to_front,
)
from acctcube.functions.dates import month_year_code, ymd_text
from acctcube.functions.nulls import differs, flag, if_else, in_set, is_true, nan_to_null
from acctcube.functions.numbers import (
    number_text,
    pct,
    ratio,
    round_even,
    round_up,
    to_number,
)

__all__ = [
    "apply_to",
    "between",
    "contains",
    "differs",
    "ends_with",
    "flag",
    "if_else",
    "in_set",
    "is_true",
    "month_year_code",
    "nan_to_null",
    "number_text",
    "pct",
    "pick",
    "ratio",
    "rename_prefix",
    "round_even",
    "round_up",
    "starts_with",
    "to_front",
    "to_number",
    "ymd_text",
]
