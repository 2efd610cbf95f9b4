"""Currency conversion."""

from __future__ import annotations

from pyspark.sql import Column


def to_usd(local_amount: Column, divisor: Column) -> Column:
    """Local amount divided by a rate, rounded half up to eight decimals.

    With sixteen decimals in the dividend the raw quotient has 23 decimals. An
    amount in cents over a seven-decimal rate is never that close to a half of the
    eighth decimal without being equal to it, so the second rounding is exact.
    """
    return (local_amount.cast("decimal(24,16)") / divisor.cast("decimal(10,7)")).cast(
        "decimal(23,8)"
    )
