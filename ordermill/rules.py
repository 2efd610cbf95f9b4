"""Market parameters and the switches between the default and the parity behaviour."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Market:
    """What distinguishes the orders of one country."""

    country: str
    region: str
    currency: str
    file_format: str
    contact_field: str  # name of the phone column in the source table
    rate_column: str  # rate stored on the curated row
    divisor_column: str  # rate the local amounts are divided by
    reads_from: str  # country whose source table is curated
    # CSV fields may hold line breaks inside quotes; files without any can be split instead.
    multi_line: bool = True
    null_tokens: tuple[str, ...] = ()  # texts that stand for NULL in JSON files

    @property
    def source_table(self) -> str:
        return f"{self.country.lower()}_sales_order"


# Country and region tags, currency codes, rate columns.
INDIA = Market("IN", "APAC", "INR", "csv", "mobile", "usd2inr", "usd2inr", "IN")
USA = Market("US", "NA", "USD", "parquet", "phone", "usd2usd", "usd2usd", "US")
FRANCE = Market("FR", "EU", "EUR", "json", "phone", "usd2eu", "usd2eu", "FR")


@dataclass(frozen=True)
class Rules:
    """Behaviour that differs between what users get and strict parity."""

    markets: tuple[Market, ...] = (INDIA, USA, FRANCE)
    null_safe_members: bool = True  # a NULL in a natural key matches a NULL
    customer_keys: tuple[str, ...] = (
        "customer_name",
        "contact_no",
        "shipping_address",
        "country",
        "region",
    )
    incremental_fact: bool = True  # only fact rows that are not there yet
    replace_days: bool = True  # a day's newer file or late rates retract its earlier orders
    padded_region_key: bool = True  # yyyyMMdd instead of y, m, d without zeros
    running_day_counter: bool = True  # does not restart each January
    whole_tax_in_named_files: bool = False  # Parquet and JSON tax loses its cents

    def market(self, country: str) -> Market:
        return next(m for m in self.markets if m.country == country)


DEFAULT = Rules()

PARITY = Rules(
    markets=(
        INDIA,
        replace(USA, rate_column="usd2inr"),
        replace(FRANCE, reads_from="US"),
    ),
    null_safe_members=False,
    customer_keys=("customer_name", "country", "region"),
    incremental_fact=False,
    replace_days=False,
    padded_region_key=False,
    running_day_counter=False,
    whole_tax_in_named_files=True,
)
