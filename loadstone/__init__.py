"""Incremental warehouse loads on PySpark."""

from loadstone.session import get_session, scratch, tune

__all__ = ["get_session", "scratch", "tune"]
