"""Imports every module that registers queries."""

from quern.queries import (  # noqa: F401
    q_aggregates,
    q_builds,
    q_functions,
    q_history,
    q_joins,
    q_lineage,
    q_quality,
    q_rows,
    q_sources,
    q_streams,
    q_versions,
)
