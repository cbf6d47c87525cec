"""Review analytics on Spark: score, explain, load and report customer reviews."""

from reviewmart.profiles import APP, BATCH, Profile

__all__ = ["APP", "BATCH", "Profile"]
