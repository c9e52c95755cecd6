"""Change-log analytics on Spark: ordered, resumable change events as DataFrames and streams."""

from tidelog.config import Config
from tidelog.plans.engine import Engine

__all__ = ["Config", "Engine"]
