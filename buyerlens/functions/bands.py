"""Price bands and device families."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Price band names, cheap to dear.
PRICE_BANDS = ["低价商品", "中价商品", "高价商品"]


def price_band(price: Column | str, low: float = 500, high: float = 1000) -> Column:
    """Below ``low``, up to and including ``high``, above; a price that is no number gives null."""
    price = F.col(price) if isinstance(price, str) else price
    price = price.try_cast("double")
    return (
        F.when(price < low, PRICE_BANDS[0])
        .when(price <= high, PRICE_BANDS[1])
        .when(price > high, PRICE_BANDS[2])
    )


def leading_os(has_ios: Column, has_android: Column, other: Column) -> Column:
    """Device family that decides the device score: iOS before Android before any other."""
    return F.when(has_ios, F.lit("iOS")).when(has_android, F.lit("Android")).otherwise(other)


def os_family(os_text: Column | str) -> Column:
    """First word of an operating-system text such as ``Android 13.0``."""
    os_text = F.col(os_text) if isinstance(os_text, str) else os_text
    return F.substring_index(os_text, " ", 1)
