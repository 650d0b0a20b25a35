"""Score tiers of the user interface as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decision threshold and tier cut points.
#   confidence: positive > 0.7 high else medium; negative < 0.3 high else medium
#   action: positive > 0.8 immediate, > 0.6 follow-up, else moderate;
#           negative < 0.2 low priority, else latent
#   band: > 70 %, 50-70 %, 30-50 %, < 30 %
DEFAULT_THRESHOLD = 0.5


def predicted(p: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Strict ``p > threshold`` as 0/1."""
    return (p > F.lit(threshold)).cast("int")


def confidence_level(p: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    pos = p > F.lit(threshold)
    return (F.when(pos & (p > 0.7), "high").when(pos, "medium")
             .when(p < 0.3, "high").otherwise("medium"))


def action_tier(p: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    pos = p > F.lit(threshold)
    return (F.when(pos & (p > 0.8), "immediate_action")
             .when(pos & (p > 0.6), "follow_up")
             .when(pos, "moderate_opportunity")
             .when(p < 0.2, "low_priority")
             .otherwise("latent_potential"))


def probability_band(p: Column) -> Column:
    return (F.when(p > 0.7, "high").when(p >= 0.5, "medium")
             .when(p >= 0.3, "moderate").otherwise("low"))


def score_tiers(df: DataFrame, p: str = "probabilidad_compra",
                threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    c = F.col(p)
    return df.select("*",
                     predicted(c, threshold).alias("prediccion_compra"),
                     confidence_level(c, threshold).alias("confidence_level"),
                     action_tier(c, threshold).alias("action_tier"),
                     probability_band(c).alias("probability_band"))
