"""Air-traffic analytics as DataFrame-to-DataFrame operators for Spark.

Layout
------
functions   column expressions (bands, regions, capacities, rounding, text)
sources     decoding, readers, writers and the replay-safe result tables
operators   one DataFrame operator per module topic (joins, metrics, alerts, ...)
plans       compositions: row enrichment, batch report, monitoring views
streaming   the foreachBatch pipeline
"""
