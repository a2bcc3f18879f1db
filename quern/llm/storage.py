"""Tables kept between the steps of an operator, below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quern.session import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet and go on from the files: evaluated once, and safe from lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
