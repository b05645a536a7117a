"""Scores and weights of behaviour events."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recoflow.functions.text import labelled

# Points and weights per behaviour type, bounds of a rating.
PREFERENCE_POINTS = {"VIEW": 1.0, "CLICK": 1.0, "ADD_TO_CART": 3.0, "PURCHASE": 5.0}
EVENT_WEIGHTS = {"VIEW": 1.0, "CLICK": 1.0, "ADD_TO_CART": 3.0, "PURCHASE": 5.0, "RATE": 4.0}
BEHAVIOR_TYPES = list(EVENT_WEIGHTS)
MIN_RATING, MAX_RATING = 1.0, 5.0


def preference_score(behavior_type: Column, rating: Column) -> Column:
    """Score used by the preference pipeline: a rating counts 0 … 4, unknown types count nothing."""
    rated = F.greatest(F.lit(0.0), F.least(F.lit(4.0), F.coalesce(rating, F.lit(1.0)) - 1.0))
    return F.when(behavior_type == "RATE", rated).otherwise(labelled(behavior_type, PREFERENCE_POINTS, 0.0))


def event_weight(behavior_type: Column, rating: Column) -> Column:
    """Weight used by behaviour analysis: any rating scales the weight of its type to 0 … 1."""
    base = labelled(behavior_type, EVENT_WEIGHTS)
    present = rating.isNotNull() & (rating != 0.0)
    return F.when(present, base * ((rating - MIN_RATING) / (MAX_RATING - MIN_RATING))).otherwise(base)


def is_valid_rating(rating: Column) -> Column:
    """Within bounds; NaN sorts above every number and so fails the upper bound."""
    return F.coalesce(rating.between(MIN_RATING, MAX_RATING), F.lit(False))


def parsed_behavior_type(action: Column) -> Column:
    """Upper-cased type, or null when it is not one of the known types."""
    upper = F.upper(action)
    return F.when(upper.isin(BEHAVIOR_TYPES), upper)
