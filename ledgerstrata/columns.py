"""Column names of the three layers, so every operator also runs on differently named tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Columns:
    id: str = "transaction_id"
    booked_at: str = "booked_at"
    amount: str = "amount"
    type: str = "transaction_type"
    date: str = "booked_date"
    valid: str = "amount_valid"
    total: str = "daily_total"
    count: str = "record_count"


DEFAULT = Columns()
