"""Spark-native short-read variant analytics: DataFrame in, DataFrame out."""

from lociframe.session import get_session, read_table

__all__ = ["get_session", "read_table"]
