"""Delay categories, causes and derived rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schema import CANCELLATION_REASONS, DELAY_EDGES, DELAY_LABELS


def delay_category(delay: Column, edges: Sequence[float] = DELAY_EDGES,
                   labels: Sequence[str] = DELAY_LABELS) -> Column:
    """Right-closed bins: a delay equal to an edge belongs to the lower bin."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    picked = F.when(delay.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        picked = picked.when(delay <= F.lit(edge), F.lit(label))
    return picked.otherwise(F.lit(labels[-1]))


def category_rank(category: Column, labels: Sequence[str] = DELAY_LABELS) -> Column:
    """Position of a category label, for sorting text categories in bin order."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), category)
    return F.when(position > 0, position.cast("int") - 1)


def dominant_cause(causes: Sequence[str]) -> Column:
    """Name of the largest cause; the earlier one wins a tie; NULL without minutes."""
    cells = [F.col(c) for c in causes]
    largest = F.greatest(*cells) if len(cells) > 1 else cells[0]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cells), F.lit(0.0))
    name = F.coalesce(*[F.when(F.col(c) == largest, F.lit(c)) for c in causes])
    return F.when(total > 0, name)


def clip(c: Column, low: float, high: float) -> Column:
    """Winsorise; NULL stays NULL (greatest/least would otherwise drop it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c.cast("double"))))


def cancellation_reason(code: Column) -> Column:
    picked = F.when(F.lit(False), F.lit(None).cast("string"))
    for letter, reason in CANCELLATION_REASONS.items():
        picked = picked.when(code == F.lit(letter), F.lit(reason))
    return picked


def is_operated() -> Column:
    return (F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0)


def percent(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator) * 100
