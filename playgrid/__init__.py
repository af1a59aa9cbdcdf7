"""playgrid: product-analytics marts on PySpark.

Layout:
  functions/  Column -> Column helpers (JSON payload access, safe casts, macros)
  operators/  reusable relational building blocks (latest version, last known,
              as-of join, interval join, dense grids, running sums, sinks)
  sources/    driver tables -> reference-shaped inputs, JSON ingest
  plans/      the named marts (staging, core, revenue, cohorts, BI, levels,
              clans, forecast, alerts, lookup, quality)
  streaming/  Structured Streaming variants of the polling jobs
  oracle/     DuckDB SQL written from the definitions, used as a test oracle
"""

from playgrid.session import get_spark  # noqa: F401
