"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """The top-level column called ``name``, also when the name holds dots or backticks."""
    return F.col(ident(name))


def ident(name: str) -> str:
    """The same as SQL text. Operators write expressions over many columns as one SQL text:
    Spark parses it at once, while each Column operation is a call into the JVM."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: bool | float | str) -> str:
    """A number, truth value or text as SQL text; floats keep every digit."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{float(value)!r}D" if math.isfinite(value) else f"double('{value}')"
    return str(value)


def all_of(conditions: Iterable[str]) -> str:
    """Conjunction; true when there is no condition."""
    return " AND ".join(f"({c})" for c in conditions) or "true"


def any_of(conditions: Iterable[str]) -> str:
    """Disjunction in three-valued logic: true OR null is true, false OR null is null."""
    return " OR ".join(f"({c})" for c in conditions) or "false"


def present(field: T.StructField) -> str:
    """True where the column is neither null nor, for floating point types, NaN.

    Says what ``dropna`` says, but as plain comparisons, so that ``IsNotNull`` reaches the
    Parquet reader.
    """
    column = ident(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return f"{column} IS NOT NULL AND NOT isnan({column})"
    return f"{column} IS NOT NULL"


def elapsed(start: str | Column, end: str | Column, unit_seconds: float = 60.0) -> Column:
    """Time from ``start`` to ``end`` in units of ``unit_seconds`` (minutes by default).

    Works on whole seconds: fractions are dropped towards zero on both sides. Takes zoned
    timestamps and ``timestamp_ntz``.
    """
    first, last = (named(c) if isinstance(c, str) else c for c in (start, end))
    return (F.unix_timestamp(last) - F.unix_timestamp(first)) / F.lit(float(unit_seconds))


def encode_label(column: str | Column, mapping: Mapping[object, float]) -> Column:
    """``mapping[value]`` as a double; NULL for every value the mapping does not name."""
    value = named(column) if isinstance(column, str) else column
    encoded = F.lit(None).cast("double")
    for key, label in reversed(list(mapping.items())):
        encoded = F.when(value == F.lit(key), F.lit(float(label))).otherwise(encoded)
    return encoded


@dataclass(frozen=True)
class Range:
    """Bounds on one column; the bounds given must all hold."""

    column: str
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None

    def condition(self) -> str:
        bounds = ((">", self.gt), (">=", self.ge), ("<", self.lt), ("<=", self.le))
        return all_of(
            f"{ident(self.column)} {sign} {literal(bound)}"
            for sign, bound in bounds
            if bound is not None
        )


def hash_bucket(keys: Sequence[str], algorithm: str = "md5") -> Column:
    """A bucket from 0 to 99 that depends on the key values alone.

    ``md5`` reads the first 8 hex digits of the digest of the keys joined by ``|``, and any
    SQL engine can reproduce it. ``xxhash64`` hashes the native values without turning them
    into text, which costs a fraction of it.
    """
    if not keys:
        raise ValueError("name at least one key column")
    columns = [ident(k) for k in keys]
    if algorithm == "xxhash64":
        return F.expr(f"CAST(pmod(xxhash64({', '.join(columns)}), 100) AS int)")
    if algorithm != "md5":
        raise ValueError(f"unknown hash algorithm: {algorithm!r}")
    text = ", ".join(f"coalesce(CAST({c} AS string), '')" for c in columns)
    digits = f"substring(md5(concat_ws('|', {text})), 1, 8)"
    return F.expr(f"CAST(CAST(conv({digits}, 16, 10) AS bigint) % 100 AS int)")
