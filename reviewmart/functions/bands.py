"""Age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_group(age: Column) -> Column:
    """Band of an age; null at or below 0 and above 100."""
    return (
        F.when((age <= 0) | (age > 100), None)
        .when(age <= 25, "18-25")
        .when(age <= 35, "26-35")
        .when(age <= 50, "36-50")
        .when(age <= 100, "50+")
    )
