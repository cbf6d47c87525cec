"""Issue reasons and advice from the profile's rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmart.functions.text import contains_any
from reviewmart.profiles import NEGATIVE, NO_TEXT_REASON, Profile


def _first_match(lowered: Column, rules, default: str) -> Column:
    cases = F
    for reason, words in rules:
        cases = cases.when(contains_any(lowered, words), reason)
    return cases.otherwise(default)


def issue_reason(lowered: Column, sentiment: Column, profile: Profile) -> Column:
    """First matching reason for lower-cased text under its sentiment class.

    Pass ``lower(text)`` from its own projection: the rules look at it some 40 times.
    """
    return (
        F.when(lowered.isNull(), NO_TEXT_REASON)
        .when(
            sentiment == NEGATIVE,
            _first_match(lowered, profile.negative_rules, profile.negative_default),
        )
        .otherwise(_first_match(lowered, profile.other_rules, profile.other_default))
    )


def recommend(reason: Column, profile: Profile) -> Column:
    """Advice for a reason, the profile's default for any other value."""
    cases = F
    for name, advice in profile.advice:
        cases = cases.when(reason == name, advice)
    return cases.otherwise(profile.default_advice)
