"""Column functions: numbers, text, dates, flags, nested values. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """Currency as exact decimals, so sums do not depend on row order."""
    return as_col(value).cast(MONEY)


def scaled(value: Column | str, factor: str, digits: int = 2) -> Column:
    """Multiply by a decimal factor given as text ('0.9') and round half up."""
    return F.round(as_col(value) * F.lit(factor).cast("decimal(18,6)"), digits)


def tier(value: Column | str, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label by thresholds: the first step whose minimum is reached wins, the bound itself included."""
    column = as_col(value)
    (first_min, first_label), *rest = steps
    out = F.when(column >= first_min, F.lit(first_label))
    for minimum, label in rest:
        out = out.when(column >= minimum, F.lit(label))
    return out.otherwise(F.lit(default))


def flag(predicate: Column | str) -> Column:
    """A comparison kept as a boolean column."""
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def default_to(*values: Column | str, value) -> Column:
    """First non-null of the columns, or the literal."""
    return F.coalesce(*[as_col(v) for v in values], F.lit(value))


def clean_text(value: Column | str) -> Column:
    return F.lower(as_col(value))


def as_date(value: Column | str) -> Column:
    return F.to_date(as_col(value))


def minor_units(value: Column | str, divisor: int = 100, digits: int = 2) -> Column:
    """Cents to currency, exact: decimal division, then round half up."""
    return F.round(as_col(value).cast("decimal(18,0)") / F.lit(divisor).cast("decimal(10,0)"), digits).cast(
        f"decimal(18,{digits})"
    )


def bucket_key(value: Column | str, n: int, offset: int = 0) -> Column:
    """A key in offset … offset+n-1; `pmod` keeps negative input inside the range."""
    return F.pmod(as_col(value), F.lit(n)) + F.lit(offset)


def product(a: Column | str, b: Column | str) -> Column:
    return as_col(a) * as_col(b)


def pack(name: str, cols: Sequence[str]) -> Column:
    """Several columns as one struct."""
    return F.struct(*cols).alias(name)


def map_get(value: Column | str, key: str) -> Column:
    """Map value by key; null when the key is missing."""
    return F.try_element_at(as_col(value), F.lit(key))


def code_labels(value: Column | str, mapping: Mapping, default: str) -> Column:
    """Label a code from a small dictionary held as a literal map; unknown and null codes get the default."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_col(value)), F.lit(default))
