"""Payment-fraud enrichment on Spark DataFrames and Structured Streaming."""

from fraudspark.config import EngineConfig

__all__ = ["EngineConfig"]
