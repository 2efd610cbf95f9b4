"""Text pieces used in dimension members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a product key in order, and the stand-in promo code.
PRODUCT_PARTS = ("brand", "model", "color", "memory")
NO_PROMOTION = "NA"


def product_parts(mobile_key: Column) -> dict[str, Column]:
    """Parts of brand/model/color/memory; a missing part is NULL."""
    pieces = F.split(mobile_key, "/")
    return {name: F.get(pieces, F.lit(i)).cast("string") for i, name in enumerate(PRODUCT_PARTS)}


def promotion_or_default(code: Column) -> Column:
    return F.coalesce(code, F.lit(NO_PROMOTION))


def region_key(region: Column, country: Column, stamp: Column) -> Column:
    """REG_<last two letters of the region>_<country>_<stamp>."""
    return F.concat(
        F.lit("REG_"), F.substring(region, -2, 2), F.lit("_"), country, F.lit("_"), stamp
    )
