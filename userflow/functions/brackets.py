"""Age brackets as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bracket labels with their inclusive bounds, in display order.
YOUNGEST, ADULT_AGE = "0-17", 18
MIDDLE = (
    ("18-24", 18, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
)
OLDEST = "65+"
LABELS = (YOUNGEST, *(label for label, _, _ in MIDDLE), OLDEST)


def age_bracket(age: Column | str, unknown_label: str | None = None) -> Column:
    """Bracket label of an age.

    Anything no bracket claims is ``65+``, a null age included. With
    ``unknown_label`` null ages get that label instead.
    """
    age = F.col(age) if isinstance(age, str) else age
    known = reduce(
        lambda chain, b: chain.when(age.between(b[1], b[2]), b[0]),
        MIDDLE,
        F.when(age < ADULT_AGE, YOUNGEST),
    )
    if unknown_label is not None:
        known = known.when(age.isNull(), unknown_label)
    return known.otherwise(OLDEST)


def bracket_rank(label: Column | str) -> Column:
    """Position of a label in display order; labels of no bracket come last."""
    label = F.col(label) if isinstance(label, str) else label
    place = F.array_position(F.array(*map(F.lit, LABELS)), label)
    return F.when(place > 0, place.cast("int")).otherwise(len(LABELS) + 1)
