"""Columns of the run explorer: colours, number and time formats, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colours of the scores 0 to 5, and the two of the highlight mode.
SCORE_COLOURS = ("#000000", "#0000FF", "#00FF00", "#FF0000", "#FFFF00", "#FF00FF")
HIGHLIGHTED = "#0000FF"
NOT_HIGHLIGHTED = "#80808020"


def score_colour(score: Column, highlight: int | None = None) -> Column:
    """Colour of a score: by its integer part modulo six, or one score against the others.

    NaN, infinite and huge scores have no integer part here and count as zero.
    """
    whole = F.coalesce(F.when(~F.isnan(score.cast("double")), score.cast("double")).try_cast("bigint"), F.when(score.isNotNull(), F.lit(0)))
    slot = F.pmod(whole, F.lit(len(SCORE_COLOURS)))
    if highlight is not None:
        return F.when(slot == highlight, F.lit(HIGHLIGHTED)).otherwise(F.lit(NOT_HIGHLIGHTED))
    return F.get(F.array(*[F.lit(c) for c in SCORE_COLOURS]), slot.cast("int"))


def keyword_text(keywords: Column) -> Column:
    return F.array_join(keywords, " ")


def one_decimal(x: Column) -> Column:
    """``%.1f`` of the exact binary value, ties to even.

    Spark's formatter rounds the shortest decimal form half up. Here a value equal to the double
    nearest the midpoint is placed by the sign of that double's own error, which the two
    products by powers of two give without rounding. Doubles from 2^53 on are whole numbers; beyond
    the range of a long they are written in their shortest digits. NaN and infinities by name.
    """
    magnitude = F.abs(x)
    below = F.when(magnitude < 2.0**53, magnitude)
    units = F.floor(below)
    tenths = _tenths(below - units)  # the fraction is exact
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    usual = F.concat(sign, (units + F.floor(tenths / 10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    huge = F.concat(F.coalesce(x.try_cast("bigint").cast("string"), x.try_cast("decimal(38,0)").cast("string"), x.cast("string")), F.lit(".0"))
    named = F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("inf")).when(x == float("-inf"), F.lit("-inf"))
    return F.when(x.isNotNull(), F.coalesce(named, usual, huge))


def _tenths(fraction: Column) -> Column:
    """A fraction in tenths, rounded as ``%.1f`` does."""
    tenths = F.floor(fraction * 10)
    # The product may round up past an integer; step back where it did.
    tenths = F.when(tenths / F.lit(10.0) > fraction, tenths - 1).otherwise(tenths)
    odd = (tenths * 2 + 1).cast("double")
    midpoint = odd / F.lit(20.0)
    error = (midpoint * 16 - odd) + midpoint * 4
    up = (
        F.when(fraction != midpoint, fraction > midpoint)
        .when(error != 0, error > 0)
        .otherwise(tenths % 2 == 1)
    )
    return tenths + F.when(up, F.lit(1)).otherwise(F.lit(0))


def minute_stamp(epoch_seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` of epoch seconds in the session's time zone."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd HH:mm")


def model_key(model: Column, language: Column, dataset_id: Column) -> Column:
    return F.concat_ws("-", model, language, dataset_id)


def round_half_even(x: Column) -> Column:
    return F.rint(x)


def clamp(x: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))
