"""Spark-native record reconciliation and analytics engine."""
