"""Residues of a text's MD5 number, without 128-bit arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Least common multiple of 2, 3, 5, 6, 7, 45, 50 and 1000: every attribute derives from
# this one residue, so the digest is folded once per row.
BUCKETS = 63_000

# Hex digits (first position, length) and the power of two each part is worth.
_PARTS = ((1, 11, 84), (12, 11, 40), (23, 10, 0))


def md5_fold(text: Column, m: int) -> Column:
    """``int(md5(text)) mod m`` as a long, for ``m`` below 2**30."""
    if not 0 < m < 2**30:
        raise ValueError("modulus must lie between 1 and 2**30 - 1")
    digest = F.md5(text)
    total = None
    for start, length, power in _PARTS:
        part = F.conv(F.substring(digest, start, length), 16, 10).cast("long")
        term = (part % F.lit(m).cast("long")) * F.lit(pow(2, power, m)).cast("long")
        total = term if total is None else total + term
    return total % F.lit(m).cast("long")


def text_bucket(text: Column) -> Column:
    """``int(md5(text)) mod BUCKETS`` as an int."""
    return md5_fold(text, BUCKETS).cast("int")
