"""Masked values are NULL. These are the mask operations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_mask(value: Column, mask: Column) -> Column:
    """The value where the mask is true, else NULL; a masked mask masks."""
    return F.when(mask, value)


def self_mask(value: Column) -> Column:
    """NULL where the value is 0, also for class code 0."""
    return F.nullif(value, F.lit(0))


def unmask(df: DataFrame, bands: list[str], value: float = 0) -> DataFrame:
    """NULLs of the bands become the value."""
    return df.fillna(value, subset=bands)


def valid(value: Column) -> Column:
    """1 where there is a value, else 0."""
    return value.isNotNull().cast("int")


def drop_masked(df: DataFrame, bands: list[str]) -> DataFrame:
    """Rows with a value in every band."""
    return df.dropna(subset=bands)
