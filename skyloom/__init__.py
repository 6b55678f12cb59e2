"""Skyloom: aircraft telemetry features and model data as Spark jobs.

functions   column expressions (geometry, time, routes)
sources     schemas, raw-report parsing, lake tables
operators   DataFrame -> DataFrame steps: cleaning, joins, windows, quality, views, models, metrics
streaming   the same steps as Structured Streaming queries
plans       whole jobs, and the queries registered over the test tables
"""
