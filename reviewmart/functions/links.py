"""Source tags written at load time and read back by the records view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmart.profiles import MANUAL_SOURCE

_TAGS = ("merged", "csv", "dataset", "page", "manual")


def source_tag(kind: str, detail: Column | None = None) -> Column:
    """Source link of one ingestion path; ``detail`` is its source, file, slug or address."""
    if kind == "merged":
        return F.concat(F.lit("Merged Pipeline ("), detail, F.lit(")"))
    if kind == "csv":
        return F.concat(F.lit("Local CSV ("), detail, F.lit(")"))
    if kind == "dataset":
        return F.concat(F.lit("https://www.kaggle.com/datasets/"), detail)
    if kind == "page":
        return detail
    if kind == "manual":
        return F.lit(MANUAL_SOURCE)
    raise ValueError(f"unknown source kind {kind!r}, expected one of {_TAGS}")


def source_type(link: Column) -> Column:
    """Kind of source told from its link."""
    text = F.coalesce(link, F.lit("None"))
    return (
        F.when(
            text.startswith("http"),
            F.when(F.lower(text).contains("kaggle"), "Kaggle Dataset").otherwise("Web Scraped"),
        )
        .when(text.contains("Manual"), "Manual Entry")
        .otherwise("Local CSV")
    )


def source_url(link: Column) -> Column:
    """The link when it can be followed, else null."""
    return F.when(link.startswith("http"), link)
