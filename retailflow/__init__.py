"""retailflow: a Spark-native retail lakehouse (bronze -> silver -> gold).

Layout
------
functions/  column expressions (labels, ratios, keyed draws, calendar parts)
operators/  DataFrame operators (joins, aggregates, skew-safe windows, grids)
sources/    driver-table fixtures, catalog IO and metadata, synthetic generators
plans/      the table jobs: silver, gold, data quality, end-to-end runner
"""

__version__ = "0.1.0"
