"""Accountability reporting on Spark DataFrames."""

from acctcube.session import build_session

__all__ = ["build_session"]
