"""Job states."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A job in one of these states will not change again.
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "STOPPED")


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL_STATES)


def outcome(status: Column) -> Column:
    """``success`` or ``failure`` once terminal, else ``pending``."""
    return F.when(status == "SUCCEEDED", "success").when(is_terminal(status), "failure").otherwise("pending")
