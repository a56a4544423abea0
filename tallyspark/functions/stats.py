"""Statistics of the marts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(num: Column | str, den: Column | str, factor: float = 1.0) -> Column:
    """num / den * factor as doubles; null unless den is above 0."""
    n = (F.col(num) if isinstance(num, str) else num).cast("double")
    d = (F.col(den) if isinstance(den, str) else den).cast("double")
    ratio = n / d if factor == 1.0 else n / d * F.lit(factor)
    return F.when(d > 0, ratio)


def clamp(value: Column, low: float, high: float) -> Column:
    """Between low and high; a null counts as low."""
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def passer_rating(attempts: str, completions: str, yards: str, touchdowns: str, interceptions: str) -> Column:
    """The four clamped terms of the passer rating; null without attempts, a null part contributes 0."""
    per = {c: F.col(c).cast("double") / F.col(attempts).cast("double") for c in (completions, yards, touchdowns, interceptions)}
    terms = [(per[completions] - 0.3) * 5.0, (per[yards] - 3.0) * 0.25, per[touchdowns] * 20.0, F.lit(2.375) - per[interceptions] * 25.0]
    total = clamp(terms[0], 0.0, 2.375)
    for term in terms[1:]:
        total = total + clamp(term, 0.0, 2.375)
    return F.when(F.col(attempts) > 0, total / 6.0 * 100.0)
