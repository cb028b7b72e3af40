"""forgeline: batch analytics for manufacturing telemetry on Spark DataFrames.

Layers:
  sources/    CSV reads, Parquet table store (insert-if-absent, upsert), driver-table bindings
  functions/  scalar Column expressions (timestamp guard, integer parse, row reference, ratios)
  operators/  reusable DataFrame -> DataFrame operators (validation, dedup, top-1, z-score, forest, DQ tests)
  plans/      the composed models: staging, intermediate, marts, ingest, scoring, daily run
  streaming/  file-arrival ingest via Structured Streaming + foreachBatch
  catalog/    one registered query per operator key, with its DuckDB oracle SQL
"""

__version__ = "0.1.0"
