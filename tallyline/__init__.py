"""Spark-native analytics for content interactions: catalog, event log, projections, reports."""
