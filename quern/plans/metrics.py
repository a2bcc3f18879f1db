"""Named measures over declared dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max, "count_distinct": F.count_distinct}


@dataclass(frozen=True)
class SemanticModel:
    """A frame with its entities (primary, foreign), dimensions and measures {name: (aggregate, expression)}."""

    frame: DataFrame
    measures: Mapping[str, tuple[str, str]]
    categorical: Sequence[str] = ()
    time: str | None = None
    entities: Mapping[str, str] = field(default_factory=dict)


def metric(
    model: SemanticModel, measures: Sequence[str], dims: Sequence[str] = (), grain: str | None = None
) -> DataFrame:
    """Measures by the chosen dimensions and time grain, in one grouped pass."""
    unknown = [m for m in measures if m not in model.measures]
    known_dims = {*model.categorical, *model.entities.values()}
    unknown += [d for d in dims if d not in known_dims]
    if unknown or (grain and not model.time):
        raise LookupError(f"not declared: {unknown or 'a time dimension'}")
    by = [F.col(d) for d in dims]
    if grain:
        by.append(F.date_trunc(grain, F.col(model.time)).cast("timestamp_ntz").alias(f"{model.time}_{grain}"))
    aggs = [AGGREGATES[model.measures[m][0]](F.expr(model.measures[m][1])).alias(m) for m in measures]
    return model.frame.groupBy(*by).agg(*aggs)
