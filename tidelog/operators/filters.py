"""Filters over the log: time cutoff, collections, ownership, generations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import before_cutoff


def skip_until(log: DataFrame, cutoff_ns: int) -> DataFrame:
    """log with `delivered` and `acked`: documents before the cutoff are not delivered and count as acknowledged."""
    skipped = before_cutoff(F.col("kind"), F.col("cas"), cutoff_ns)
    acked = F.col("acked") if "acked" in log.columns else F.lit(False)
    return log.withColumns({"delivered": ~skipped, "acked": acked | skipped})


def in_collections(log: DataFrame, ids: list[int]) -> DataFrame:
    """Documents of the collections and all events without one; pushed down to the scan."""
    return log.where(F.col("collection_id").isNull() | F.col("collection_id").isin(*ids))


def owned(log: DataFrame, assignment: DataFrame) -> DataFrame:
    return log.join(F.broadcast(assignment.select("shard").distinct()), "shard", "left_semi")


def current_generation(log: DataFrame, connection: int, assignment: int | None = None) -> DataFrame:
    """Rows of the current connection generation (and assignment generation); the rest is stale."""
    x = log.where(F.col("connection_generation") == connection)
    return x if assignment is None else x.where(F.col("assignment_generation") == assignment)
