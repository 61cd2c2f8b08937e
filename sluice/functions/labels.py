"""Labels put on rows and groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The severities that count as critical and as warning.
CRITICAL = "CRITICAL"
WARNING = ("HIGH", "CRITICAL")


def is_critical(severity: Column) -> Column:
    return severity == CRITICAL


def is_warning(severity: Column) -> Column:
    return severity.isin(*WARNING)


def risk_band(critical_events: Column, high_events: Column) -> Column:
    """The worst band with any events in it."""
    return (
        F.when(critical_events > 0, "CRITICAL_ATTENTION")
        .when(high_events > 0, "WATCHLIST")
        .otherwise("NORMAL")
    )
