"""Spark-native hospital costing: ingest, allocate, fund, reconcile, report."""
