"""Unsupervised anomaly detection on network-flow and connection tables, as Spark jobs."""
