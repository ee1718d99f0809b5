"""Keyed reports: histogram, integer mean, min/max readings, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_histogram(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Occurrences of each value, ordered by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(col)


def int_avg_by_key(df: DataFrame, key: str, value: str, name: str = "avg_value") -> DataFrame:
    """Mean per key with integer division (sum div count), ordered by key."""
    avg = F.expr(f"sum(`{value}`) div count(`{value}`)").alias(name)
    return df.groupBy(key).agg(avg).orderBy(key)


def fahrenheit_hundredths(tenths_celsius):
    """Tenths of a degree Celsius -> hundredths of a degree Fahrenheit, rounded half up.

    value * 0.1 * 9/5 + 32 degrees is value * 18 + 3200 hundredths; rounding that instead
    of formatting a binary fraction keeps the text identical across engines.
    """
    return F.round(tenths_celsius * F.lit(18.0) + F.lit(3200.0)).cast("bigint")


def degrees_label(hundredths, unit: str = "F"):
    """``%.2f <unit>`` text from integer hundredths."""
    sign = F.when(hundredths < 0, F.lit("-")).otherwise(F.lit(""))
    a = F.abs(hundredths)
    return F.format_string(f"%s%d.%02d {unit}", sign, F.floor(a / 100).cast("bigint"), a % 100)


def min_reading_by_station(readings: DataFrame, kind: str = "TMIN", fahrenheit: bool = True) -> DataFrame:
    """Minimum reading per station over ``kind`` rows; converted to Fahrenheit with a
    two-decimal label. The filter is pushed to the scan; conversion happens once per
    station after the (monotone) minimum."""
    mins = (readings.filter(F.col("type") == kind).groupBy("station")
            .agg(F.min("value").alias("min_value")))
    if not fahrenheit:
        return mins.orderBy("station")
    h = fahrenheit_hundredths(F.col("min_value"))
    return (mins.select("station", (h / F.lit(100.0)).alias("min_temp"), degrees_label(h).alias("label"))
            .orderBy("station"))


def max_reading_by_station(readings: DataFrame, kind: str = "TMAX") -> DataFrame:
    """Maximum raw reading per station over ``kind`` rows (no unit conversion)."""
    return (readings.filter(F.col("type") == kind).groupBy("station")
            .agg(F.max("value").alias("max_value")).orderBy("station"))


def spend_by_customer(spend: DataFrame, decimals: int = 2) -> DataFrame:
    """Total amount per customer, ascending by total. Amounts are summed as decimals,
    so the cents do not depend on the order of the rows."""
    exact = F.sum(F.col("amount").cast(f"decimal(28,{decimals + 4})"))
    return (spend.groupBy("customer").agg(F.round(exact, decimals).cast("double").alias("total"))
            .orderBy("total", "customer"))
