"""Column expressions."""

from insight.functions.columns import (
    Range,
    all_of,
    any_of,
    elapsed,
    encode_label,
    hash_bucket,
    ident,
    literal,
    named,
    present,
)

__all__ = [
    "Range",
    "all_of",
    "any_of",
    "elapsed",
    "encode_label",
    "hash_bucket",
    "ident",
    "literal",
    "named",
    "present",
]
