"""forumlens: analytics over a question-and-answer site's dump, on Spark.

Layout
------
sources/    driver-table fixtures, the line-per-row XML dump (render / read /
            ingest) and the Parquet sink
functions/  column expressions (validity tests, timestamps, tags, ratios)
operators/  reusable DataFrame operators (conditional counts, first row per
            key, ranked top-k)
plans/      the analyses Q0-Q7 and the registry of queries + oracle SQL
streaming/  incremental ingest of newly arriving dump files
"""

__all__ = ["session"]
