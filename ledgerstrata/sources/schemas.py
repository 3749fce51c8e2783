"""Fixed schemas of the stored layers; the partition column comes last."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION_TYPES = ["deposit", "withdrawal", "payment", "transfer", "fee"]

MONEY = T.DecimalType(18, 2)

BRONZE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("booked_at", T.TimestampNTZType()),
        T.StructField("amount", MONEY),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("booked_date", T.DateType()),
    ]
)

SILVER = T.StructType(
    BRONZE.fields[:4] + [T.StructField("amount_valid", T.BooleanType()), BRONZE.fields[4]]
)

REJECTS = T.StructType(
    BRONZE.fields[:4]
    + [
        T.StructField("reason", T.StringType()),
        T.StructField("copies", T.LongType()),
        BRONZE.fields[4],
    ]
)

GOLD = T.StructType(
    [
        T.StructField("transaction_type", T.StringType()),
        T.StructField("daily_total", MONEY),
        T.StructField("record_count", T.LongType()),
        T.StructField("booked_date", T.DateType()),
    ]
)

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
