"""Declared schemas of every table, with corrected column names."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = T.LongType()
TEXT = T.StringType()
COUNT = T.LongType()
WHOLE = T.DecimalType(38, 0)
MONEY = T.DecimalType(10, 2)
RATE = T.DecimalType(10, 7)
STORED_RATE = T.DecimalType(15, 7)
USD = T.DecimalType(23, 8)
INT = T.IntegerType()
DATE = T.DateType()
MOMENT = T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


LINEAGE = (
    ("_metadata_file_name", TEXT),
    ("_metadata_row_number", KEY),
    ("_metadata_last_modified", MOMENT),
)


def source_orders(contact_field: str) -> T.StructType:
    """Source layer: the sixteen business fields between a key and file lineage."""
    return _struct(
        ("sales_order_key", KEY),
        ("order_id", TEXT),
        ("customer_name", TEXT),
        ("mobile_key", TEXT),
        ("order_quantity", COUNT),
        ("unit_price", WHOLE),
        ("order_value", WHOLE),
        ("promotion_code", TEXT),
        ("final_order_amount", MONEY),
        ("tax_amount", MONEY),
        ("order_dt", DATE),
        ("payment_status", TEXT),
        ("shipping_status", TEXT),
        ("payment_method", TEXT),
        ("payment_provider", TEXT),
        (contact_field, TEXT),
        ("shipping_address", TEXT),
        *LINEAGE,
    )


EXCHANGE_RATE = _struct(
    ("rate_dt", DATE),
    ("usd2usd", RATE),
    ("usd2eu", RATE),
    ("usd2can", RATE),
    ("usd2uk", RATE),
    ("usd2inr", RATE),
    ("usd2jp", RATE),
)

CURATED_ORDERS = _struct(
    ("sales_order_key", KEY),
    ("order_id", TEXT),
    ("order_dt", DATE),
    ("customer_name", TEXT),
    ("mobile_key", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("order_quantity", COUNT),
    ("local_currency", TEXT),
    ("local_unit_price", WHOLE),
    ("promotion_code", TEXT),
    ("local_total_order_amt", MONEY),
    ("local_tax_amt", MONEY),
    ("exchange_rate", STORED_RATE),
    ("us_total_order_amt", USD),
    ("usd_tax_amt", USD),
    ("payment_status", TEXT),
    ("shipping_status", TEXT),
    ("payment_method", TEXT),
    ("payment_provider", TEXT),
    ("contact_no", TEXT),
    ("shipping_address", TEXT),
)

REGION_DIM = _struct(
    ("region_id_pk", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("isActive", TEXT),
)

PRODUCT_DIM = _struct(
    ("product_id_pk", KEY),
    ("mobile_key", TEXT),
    ("brand", TEXT),
    ("model", TEXT),
    ("color", TEXT),
    ("memory", TEXT),
    ("isActive", TEXT),
)

PROMO_CODE_DIM = _struct(
    ("promo_code_id_pk", KEY),
    ("promotion_code", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("isActive", TEXT),
)

CUSTOMER_DIM = _struct(
    ("customer_id_pk", KEY),
    ("customer_name", TEXT),
    ("contact_no", TEXT),
    ("shipping_address", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("isActive", TEXT),
)

PAYMENT_DIM = _struct(
    ("payment_id_pk", KEY),
    ("payment_method", TEXT),
    ("payment_provider", TEXT),
    ("country", TEXT),
    ("region", TEXT),
    ("isActive", TEXT),
)

# day_counter is added later with ALTER TABLE, see plans.warehouse.
DATE_DIM = _struct(
    ("date_id_pk", KEY),
    ("order_dt", DATE),
    ("order_year", INT),
    ("order_month", INT),
    ("order_quarter", INT),
    ("order_day", INT),
    ("order_dayofweek", INT),
    ("order_dayname", TEXT),
    ("order_dayofmonth", INT),
    ("order_weekday", TEXT),
)

SALES_FACT = _struct(
    ("order_id_pk", KEY),
    ("order_code", TEXT),
    ("date_id_fk", KEY),
    ("region_id_fk", TEXT),
    ("customer_id_fk", KEY),
    ("payment_id_fk", KEY),
    ("product_id_fk", KEY),
    ("promo_code_id_fk", KEY),
    ("order_quantity", COUNT),
    ("local_total_order_amt", MONEY),
    ("local_tax_amt", MONEY),
    ("exchange_rate", STORED_RATE),
    ("us_total_order_amt", USD),
    ("usd_tax_amt", USD),
)

LOAD_AUDIT = _struct(
    ("table_name", TEXT),
    ("load_id", TEXT),
    ("rows_written", COUNT),
    ("rows_rejected", COUNT),
    ("loaded_at", MOMENT),
)

LOAD_PROGRESS = _struct(("stage", TEXT), ("load_id", TEXT))

KEY_RANGES = _struct(
    ("table_name", TEXT), ("load_id", TEXT), ("first_key", KEY), ("last_key", KEY)
)

# Days of a load that a later load has replaced.
RETRACTED_DAYS = _struct(("table_name", TEXT), ("load_id", TEXT), ("country", TEXT), ("day", DATE))

# The days that a load's rows lie on, and whether some of them have no dollar amount.
LOAD_DAYS = _struct(
    ("table_name", TEXT), ("load_id", TEXT), ("day", T.DateType()), ("unpriced", T.BooleanType())
)
