"""What a load read, refused and stored, counted while it is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewmart.functions.text import is_blank


@dataclass(frozen=True)
class SourceTotals:
    """Rows of one source; ``missing`` are null texts, ``blank`` white space only."""

    source: str
    read: int
    missing: int
    blank: int
    loaded: int


class Watch:
    """Counts the rows of a load's sources inside the pass that writes them.

    A watched frame has to lie above any range sort, whose sampling reads its input once more.
    ``refuses`` says whether the load leaves out rows without text.
    """

    def __init__(self, refuses: bool):
        self._refuses = refuses
        self._seen: dict[str, Observation] = {}

    def rows(self, df: DataFrame, source: str) -> DataFrame:
        """``df`` (``review_text``), unchanged, and counted under a source's name."""
        text = F.col("review_text")
        self._seen[source] = Observation()
        return df.observe(
            self._seen[source],
            F.count(F.lit(1)).alias("read"),
            F.count_if(text.isNull()).alias("missing"),
            F.count_if(is_blank(text)).alias("blank"),
        )

    def totals(self) -> tuple[SourceTotals, ...]:
        """The counts, once the watched rows have been written."""
        found = []
        for source, seen in self._seen.items():
            n = seen.get
            refused = n["missing"] + n["blank"] if self._refuses else 0
            found.append(SourceTotals(source, n["read"], n["missing"], n["blank"], n["read"] - refused))
        return tuple(found)
