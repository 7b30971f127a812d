"""carelake: PySpark jobs for healthcare-style data.

Layout:
  sources/    file scans (CSV, Parquet, whole-text notes), payload tables
  functions/  column expressions (lenient casts, flags, months, exact money sums)
  operators/  table maintenance, data-quality rules, statistics, note entities,
              drug coding, treatment models
  streaming/  incremental, exactly-once file loads (Structured Streaming)
  plans/      the bronze/silver/gold flow and the registered queries
"""

from carelake.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
