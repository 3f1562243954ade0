"""Column functions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator of whole numbers, rounded half away from zero in integer arithmetic; null on zero or null.

    One rounding, no binary fractions: averages of decimals come out the same on every engine. Scale decimals to whole numbers first.
    """
    n, d = numerator.cast("decimal(38,0)"), denominator.cast("decimal(38,0)")
    whole = F.floor((F.abs(n) * (2 * 10**digits) + d) / F.when(d != 0, d * 2))
    return (F.signum(n) * whole).cast("double") / float(10**digits)


def scaled(col: Column, digits: int = 4) -> Column:
    """A decimal as a whole number of 10**-digits."""
    return (col * F.lit(10**digits)).cast("bigint")


def net_sentiment(positive: Column, negative: Column, total: Column, digits: int = 2) -> Column:
    """(positive - negative) / total in percent."""
    return ratio((positive - negative) * 100, total, digits)


def sentiment_label(score: Column, band: float) -> Column:
    return F.when(score > band, "positive").when(score < -band, "negative").otherwise("neutral")


def effective_label(model: Column, human: Column) -> Column:
    return F.coalesce(human, model)


def rating_label(rating: Column) -> Column:
    return F.when(rating.isNull(), F.lit(None).cast("string")).when(rating >= 4, "positive").when(rating <= 2, "negative").otherwise("neutral")


def sum_if(condition: Column, value: Column | None = None) -> Column:
    """Sum over the rows that meet the condition; null where none does, as a filtered aggregate gives."""
    return F.sum(F.when(condition, F.lit(1) if value is None else value))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def hours_between(later: Column, earlier: Column, digits: int = 2) -> Column:
    return ratio(F.unix_micros(later) - F.unix_micros(earlier), F.lit(3_600_000_000), digits)


def four_places(x: Column) -> Column:
    """A double rounded to four places, halves upwards, by plain double arithmetic: the same in any engine."""
    return F.floor(x * 10000.0 + 0.5) / 10000.0
