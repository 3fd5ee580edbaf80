from locus.functions.columns import (
    desc_nulls_first_key,
    empty_as_null,
    level_key,
    norm_key,
    null_of,
    parse_timestamp,
    to_int_rounded,
)
from locus.functions.recode import ADMIN2_RULES, Rule, recode, recode_column

__all__ = [
    "ADMIN2_RULES",
    "Rule",
    "desc_nulls_first_key",
    "empty_as_null",
    "level_key",
    "norm_key",
    "null_of",
    "parse_timestamp",
    "recode",
    "recode_column",
    "to_int_rounded",
]
