"""weeklens: weekly purchase-propensity analytics as Spark DataFrame jobs.

Sub-packages:
  sources    table mapping, readers and sinks
  functions  column expressions (week arithmetic, tiers) and driver-side p-values
  operators  grid, split, drift, incremental merge, features, metrics, model, explain, profile
  plans      composite jobs (weekly run, next-week scoring, file scoring)
  streaming  Structured Streaming intake of weekly transaction drops
"""

from weeklens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
