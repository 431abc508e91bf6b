"""Behavioural features from event logs, as Spark DataFrame jobs."""

from footfall.schema import DEFAULT, EventSpec

__all__ = ["DEFAULT", "EventSpec"]
