"""Sentiment column builders: normalisation, labels (V3, V4) and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Normaliser constant of the published compound score (Hutto & Gilbert 2014)
# and the two label rules of the reference.
NORMALIZE_ALPHA = 15.0
SCORED_THRESHOLD = 0.05    # inclusive, used when scoring (report)
LOADED_THRESHOLD = 0.1     # exclusive, used when loading into the table
LABELS = ("positive", "neutral", "negative")


def compound(valence_sum: Column, alpha: float = NORMALIZE_ALPHA) -> Column:
    """V1: ``s / sqrt(s*s + alpha)`` clamped to [-1, 1] (a double)."""
    s = valence_sum.cast("double")
    v = s / F.sqrt(s * s + F.lit(alpha))
    return F.least(F.greatest(v, F.lit(-1.0)), F.lit(1.0))


def label_scored(score: Column, t: float = SCORED_THRESHOLD) -> Column:
    """V3: ``>= t`` positive, ``<= -t`` negative, else neutral."""
    return F.when(score >= t, "positive").when(score <= -t, "negative").otherwise("neutral")


def label_loaded(score: Column, t: float = LOADED_THRESHOLD) -> Column:
    """V4: ``> t`` positive, ``< -t`` negative, else neutral."""
    return F.when(score > t, "positive").when(score < -t, "negative").otherwise("neutral")


def report_score(compound_score: Column) -> Column:
    """V9: the score as written in the report (three decimals), read back exactly."""
    return compound_score.cast("decimal(4,3)")


def rates(score3: Column) -> list[Column]:
    """confidence, positive, negative and neutral rates in percent, as DECIMAL(5,2)."""
    hundred = F.lit(100)
    a = F.abs(score3) * hundred
    return [
        a.cast("decimal(5,2)").alias("confidence"),
        (F.greatest(score3, F.lit(0)) * hundred).cast("decimal(5,2)").alias("positive_rate"),
        (F.greatest(-score3, F.lit(0)) * hundred).cast("decimal(5,2)").alias("negative_rate"),
        (hundred - a).cast("decimal(5,2)").alias("neutral_rate"),
    ]
