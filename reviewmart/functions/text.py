"""Text predicates and clean-up."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() set: Unicode white space plus the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"
_BLANK = rf"(?U)^{_SPACE}*\z"
_EDGES = rf"(?U)^{_SPACE}+|{_SPACE}+\z"
TOKEN_PATTERN = "[0-9a-z_]{2,}"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(text, _EDGES, "")


def is_blank(text: Column) -> Column:
    """True for text of white space only; null for null."""
    return text.rlike(_BLANK)


def has_text(text: Column) -> Column:
    """True when text is neither null nor blank."""
    return text.isNotNull() & ~is_blank(text)


def contains_any(lowered: Column, words: Iterable[str]) -> Column:
    """True when any word occurs as a substring (so ``happy`` holds ``app``).

    A chain of ``contains`` is a byte search and beats one alternation pattern about 2:1.
    """
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def to_int(value: Column) -> Column:
    """Integer part of a number or numeric text, null when it is neither."""
    return F.coalesce(value.try_cast("int"), value.try_cast("double").try_cast("int"))


def term_counts(tokens: Column) -> Column:
    """Distinct tokens with their counts: ``array<struct<term, tf>>``, by term; none for null.

    The tokens are sorted and a term's count is the distance between two starts, so a text
    costs its sort. Sorted tokens and starts are bound by ``transform`` over one-element arrays:
    otherwise they would be computed anew for each token.
    """

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
            lambda i: (n > 0) & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )
        return F.transform(
            F.array(starts),
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), n) - start).cast("long").alias("tf"),
                ),
            ),
        )[0]

    return F.transform(F.array(F.sort_array(tokens)), runs)[0]
