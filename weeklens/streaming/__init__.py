from weeklens.streaming.weekly_drop import (
    latest_state, publish_intake, run_weekly_intake, start_weekly_intake,
)

__all__ = ["start_weekly_intake", "publish_intake", "run_weekly_intake", "latest_state"]
