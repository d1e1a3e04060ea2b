"""Revision analytics on Spark: histories of versioned text as DataFrames."""

from revloom.session import build_session

__all__ = ["build_session"]
