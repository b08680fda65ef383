"""Versioned datasets, views and transforms expressed as Spark DataFrame jobs."""

from tidemark.session import build_session

__all__ = ["build_session"]
