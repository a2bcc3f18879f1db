"""Data checks. A check returns the violating rows; none means it passed. Null values pass the checks on values,
parents and uniqueness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.joins import orphans
from quern.operators.rows import diff

# Verdicts from best to worst.
STATUSES = ("pass", "warn", "error")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values seen more than once, with the count."""
    present = df.dropna(subset=list(cols))
    return present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values are compared as text."""
    return df.where(~F.col(col).cast("string").isin([str(v) for v in values]))


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    return orphans(df, parent, col, field)


def singular(fn: Callable[..., DataFrame], *inputs: DataFrame) -> DataFrame:
    """Any query whose rows are failures."""
    return fn(*inputs)


def is_positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) <= 0)


def is_between(df: DataFrame, col: str, min_val=None, max_val=None) -> DataFrame:
    """Rows below the minimum or above the maximum; the bounds themselves are allowed."""
    outside = F.lit(False)
    if min_val is not None:
        outside = outside | (F.col(col) < min_val)
    if max_val is not None:
        outside = outside | (F.col(col) > max_val)
    return df.where(outside)


def _holds(failures, condition: tuple[str, int]):
    op, n = condition
    compare = {
        ">": failures > n,
        ">=": failures >= n,
        "<": failures < n,
        "<=": failures <= n,
        "=": failures == n,
        "!=": failures != n,
    }
    return compare[op]


def status_of(failures, severity="error", warn_if=(">", 0), error_if=None):
    """Status column from a count of failures.

    `error_if` given in full counts whatever the severity; otherwise any failure is an error under severity
    'error' and no number of failures is under 'warn'.
    """
    if error_if is None and severity == "error":
        error_if = (">", 0)
    worse = F.when(_holds(failures, error_if), F.lit("error")) if error_if else None
    if worse is None:
        return F.when(_holds(failures, warn_if), F.lit("warn")).otherwise(F.lit("pass"))
    return worse.when(_holds(failures, warn_if), F.lit("warn")).otherwise(F.lit("pass"))


def verdict(
    violations: DataFrame,
    severity: str = "error",
    warn_if: tuple[str, int] = (">", 0),
    error_if: tuple[str, int] | None = None,
) -> DataFrame:
    """One row: number of failures and pass / warn / error."""
    counted = violations.agg(F.count(F.lit(1)).alias("failures"))
    return counted.withColumn("status", status_of(F.col("failures"), severity, warn_if, error_if))


def store_failures(violations: DataFrame, check: str, path: str) -> DataFrame:
    """Keep the violating rows of a check in its own audit folder, replacing those of its last run."""
    target = f"{path}/{check}"
    violations.write.mode("overwrite").parquet(target)
    return violations.sparkSession.read.schema(violations.schema).parquet(target)


def unit_test(fn: Callable[..., DataFrame], given: Sequence[DataFrame], expect: DataFrame) -> DataFrame:
    """Run the logic on given rows; report differences on the columns that the expectation names."""
    return diff(expect, fn(*given), expect.columns)


def freshness(df: DataFrame, loaded_at: str, warn_hours: int, error_hours: int, as_of: dt.datetime) -> DataFrame:
    """Age of the newest row at `as_of`, in seconds, and its status. A table without rows is an error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    status = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_hours * 3600), F.lit("error"))
        .when(F.col("age_seconds") > warn_hours * 3600, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.withColumn("age_seconds", age).withColumn("status", status)


def contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that break the declared schema: missing, undeclared, or of another type. Reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {f.name: f.dataType.simpleString() for f in schema}
    rows = []
    for name, want in declared.items():
        got = actual.get(name)
        if got is None:
            rows.append((name, want, None, "missing"))
        elif got != want:
            rows.append((name, want, got, "type"))
    rows += [(name, None, got, "undeclared") for name, got in actual.items() if name not in declared]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, problem string")


def enforce_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame, in declared column order, or an error that names every breach."""
    breaches = contract(df, schema).collect()
    if breaches:
        raise ValueError("contract broken: " + "; ".join(f"{b.column}: {b.problem}" for b in breaches))
    return df.select(*schema.names)


def roll_up(verdicts: DataFrame) -> DataFrame:
    """One verdict per model, the worst of its checks, with the number that did not pass."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    worst = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), F.max(rank).cast("int"))
    return verdicts.groupBy("model").agg(
        worst.alias("status"),
        F.count(F.lit(1)).alias("checks"),
        F.count(F.when(F.col("status") != "pass", F.lit(1))).alias("not_passed"),
    )


@dataclass(frozen=True)
class Check:
    """A named check of a suite: 'not_null', 'unique', 'accepted_values', 'positive' or 'between'."""

    name: str
    kind: str
    cols: tuple[str, ...]
    args: dict = field(default_factory=dict)
    severity: str = "error"
    warn_if: tuple[str, int] = (">", 0)
    error_if: tuple[str, int] | None = None

    def is_violation(self):
        col = F.col(self.cols[0])
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "accepted_values":
            return ~col.cast("string").isin([str(v) for v in self.args["values"]])
        if self.kind == "positive":
            return col <= 0
        if self.kind == "between":
            low, high = self.args.get("min_val"), self.args.get("max_val")
            outside = F.lit(False)
            if low is not None:
                outside = outside | (col < low)
            return outside | (col > high) if high is not None else outside
        raise ValueError(f"{self.kind} is not checked row by row")


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures and status of many checks: one scan for all row checks, one grouped pass per unique key."""
    row_checks = [c for c in checks if c.kind != "unique"]
    parts = []
    if row_checks:
        counts = df.agg(*[F.count(F.when(c.is_violation(), F.lit(1))).alias(c.name) for c in row_checks])
        names = F.array(*[F.lit(c.name) for c in row_checks])
        values = F.array(*[F.col(f"`{c.name}`") for c in row_checks])
        pairs = F.explode(F.arrays_zip(names.alias("check"), values.alias("failures"))).alias("p")
        parts.append(counts.select(pairs).select(F.col("p.check"), F.col("p.failures")))
    for c in checks:
        if c.kind == "unique":
            parts.append(
                unique(df, c.cols).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(c.name).alias("check"), "failures"
                )
            )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    status = None
    for c in checks:
        this = status_of(F.col("failures"), c.severity, c.warn_if, c.error_if)
        status = F.when(F.col("check") == c.name, this) if status is None else status.when(F.col("check") == c.name, this)
    return found.withColumn("status", status)


def mock_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Given or expected rows of a unit test."""
    return spark.createDataFrame(list(rows), schema)
