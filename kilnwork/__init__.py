"""Batch machine-learning data work on Spark: score, train, search, summarise."""

from kilnwork.session import build_session, materialise, scratch_path, ship_package

__all__ = ["build_session", "materialise", "scratch_path", "ship_package"]
