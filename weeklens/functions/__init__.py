from weeklens.functions.time import week_start, week_spine, next_week, iso_week
from weeklens.functions.tiers import (
    confidence_level, action_tier, probability_band, score_tiers,
)

__all__ = ["week_start", "week_spine", "next_week", "iso_week",
           "confidence_level", "action_tier", "probability_band", "score_tiers"]
