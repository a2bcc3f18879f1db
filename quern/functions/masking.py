"""Masking personal data, and the vectorised user function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.expressions import as_col

# Fixed value: the sales tax factor of the vectorised function.
TAX_FACTOR = 1.0825


def pseudonym(value: Column | str, pepper: str) -> Column:
    """SHA-256 of the value followed by a secret text."""
    return F.sha2(F.concat(as_col(value).cast("string"), F.lit(pepper)), 256)


def mask_name(value: Column | str) -> Column:
    """'Alice Johnson' to 'Alice J.'; one word stays; null and empty become ''."""
    name = as_col(value)
    parts = F.split(name, " ", -1)
    initial = F.substring(F.try_element_at(parts, F.lit(2)), 1, 1)
    return (
        F.when(name.isNull() | (name == ""), F.lit(""))
        .when(F.size(parts) > 1, F.concat(F.element_at(parts, 1), F.lit(" "), initial, F.lit(".")))
        .otherwise(F.element_at(parts, 1))
    )


@F.pandas_udf(T.DoubleType())
def add_tax(amount: pd.Series) -> pd.Series:
    """Amount with sales tax, one Arrow batch at a time."""
    return amount * TAX_FACTOR
