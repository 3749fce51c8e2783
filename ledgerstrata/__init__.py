"""Layered transaction analytics (Bronze, Silver, Gold) as Spark DataFrame operators."""

from ledgerstrata.columns import Columns

__all__ = ["Columns"]
