"""tidemark: cross-sectional equity research on Spark DataFrames.

Sub-packages:
  sources    readers, fixture recipes, lake writes, fingerprints, metadata tables
  functions  column-level semantics kit (null-safe clips, guarded ratios, EWM, rolling guards)
  operators  per-security time series, joins, flags, cleaning, pod, factors, prep, events, models
  plans      the registered queries and their DuckDB oracle SQL
  streaming  Structured Streaming operators over live ticks
"""

__version__ = "0.1.0"
