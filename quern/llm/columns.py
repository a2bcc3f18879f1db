"""Adding columns to a frame: from Arrow batches inside the tasks, or by name without clashes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without columns that an operator is about to add; its own columns win over the input's."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def add_from_batches(
    df: DataFrame, inputs: Sequence[str], added: T.StructType, fn: Callable[..., list[pa.Array]]
) -> DataFrame:
    """Run `fn` on the input columns of every Arrow batch and append the arrays that it returns.

    Rows keep their order and their other columns; a column of the input that has the name of an added one is
    replaced. `fn` gets one Arrow array per input and sees no more than one batch, so memory is bounded by the
    batch.
    """
    marks = [f"__in_{i}" for i in range(len(inputs))]
    kept = without(df, added.names).columns
    source = df.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(m) for c, m in zip(inputs, marks)]
    )
    names = [*kept, *added.names]
    schema = T.StructType([*[f for f in source.schema.fields if f.name not in marks], *added.fields])

    def run(batches):
        for batch in batches:
            columns = batch.columns
            new = fn(*columns[len(kept) :])
            yield pa.RecordBatch.from_arrays([*columns[: len(kept)], *new], names=names)

    return source.mapInArrow(run, schema)


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return texts.cast(pa.large_binary()).to_pylist()
