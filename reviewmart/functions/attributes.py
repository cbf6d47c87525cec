"""Synthetic customer, product and place attributes.

All of them are invented from the text's hash bucket by design: they are stable labels
for demonstration data, not facts about the reviewer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmart.functions.text import to_int
from reviewmart.profiles import (
    CLOTHING_SOURCE,
    DEFAULT_CATEGORY,
    LOCATIONS,
    Profile,
)


def _residue(bucket: Column, n: int) -> Column:
    """``bucket % n``, declared non-null.

    Catalyst calls every remainder nullable. It would then push a null check, and with it
    the whole hash, below each join on a derived key.
    """
    return F.coalesce(bucket % n, F.lit(0))


def _pick(values: tuple[str, ...], bucket: Column) -> Column:
    index = _residue(bucket, len(values)) + 1
    found = F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))
    return F.coalesce(found, F.lit(values[0]))


def _from_clothing(source: Column, profile: Profile) -> Column:
    return source == CLOTHING_SOURCE if profile.is_batch else source.contains("Womens")


def derived_age(bucket: Column) -> Column:
    """Synthetic age from 20 to 64."""
    return (F.lit(20) + _residue(bucket, 45)).cast("int")


def customer_age(bucket: Column, input_age: Column, profile: Profile) -> Column:
    """Given age where the profile keeps it, else the synthetic one."""
    if profile.is_batch:
        return F.coalesce(to_int(input_age), derived_age(bucket))
    return derived_age(bucket)


def derived_gender(bucket: Column, source: Column, profile: Profile) -> Column:
    """Synthetic gender: always Female for clothing sources, else by parity."""
    return F.when(
        ~F.coalesce(_from_clothing(source, profile), F.lit(False)) & (bucket % 2 == 0), "Male"
    ).otherwise("Female")


def customer_name(gender: Column, bucket: Column) -> Column:
    """``Customer_<initial>_<0..999>``."""
    number = _residue(bucket, 1000).cast("string")
    return F.concat(F.lit("Customer_"), F.substring(gender, 1, 1), F.lit("_"), number)


def product_category(source: Column, input_category: Column, profile: Profile) -> Column:
    """Given category in the batch profile (missing or empty: the default), else by source."""
    if profile.is_batch:
        given = F.when(input_category != "", input_category)
        return F.coalesce(given, F.lit(DEFAULT_CATEGORY))
    return F.when(_from_clothing(source, profile), "Apparel").otherwise(DEFAULT_CATEGORY)


def brand(bucket: Column, profile: Profile) -> Column:
    """Synthetic brand from the profile's list."""
    return _pick(profile.brands, bucket)


def product_name(brand_name: Column, bucket: Column) -> Column:
    """``Product_<brand>_<0..49>``."""
    number = _residue(bucket, 50).cast("string")
    return F.concat(F.lit("Product_"), brand_name, F.lit("_"), number)


def country(bucket: Column) -> Column:
    """Synthetic country."""
    return _pick(tuple(c for c, _ in LOCATIONS), bucket)


def city(bucket: Column) -> Column:
    """Synthetic city of the synthetic country."""
    # bucket mod 5 fixes the country and bucket mod 3 the city, so 15 pairs cover both.
    pairs = tuple(LOCATIONS[i % 5][1][i % 3] for i in range(15))
    return _pick(pairs, bucket)
