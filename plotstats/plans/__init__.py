"""Registered queries: name -> (function of session and data folder, checking SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def catalogue() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    from plotstats.plans import (
        function_queries,
        incremental,
        join_queries,
        observation_queries,
        raster_queries,
        scans,
        statistics,
        training,
    )

    merged: dict = {}
    for part in (
        scans,
        observation_queries,
        statistics,
        join_queries,
        function_queries,
        raster_queries,
        training,
        incremental,
    ):
        merged.update(part.QUERIES)
    return merged
