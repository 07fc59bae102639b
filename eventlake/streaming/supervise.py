"""Waiting on several streaming queries as one job."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


def start_all(starters: Sequence[Callable[[], StreamingQuery | None]]) -> list[StreamingQuery]:
    """Start queries in order; if one fails to start, stop those already running."""
    queries: list[StreamingQuery] = []
    try:
        for start in starters:
            query = start()
            if query is not None:
                queries.append(query)
    except Exception:
        stop_all(queries)
        raise
    return queries


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def await_any(queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until one query ends, stop the others, and raise its error if it failed.

    Watches every query of the group: a failure in any of them ends the job.
    """
    try:
        while not any(query.awaitTermination(poll_seconds) for query in queries):
            pass
    finally:
        stop_all(queries)


def await_all(queries: Sequence[StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Block until all queries end (available-now runs); the first error stops the rest.

    Watches every query: a failure of any is raised while others still run.
    """
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(poll_seconds)]
    finally:
        stop_all(queries)
