"""Industrial electricity telemetry on Spark: features, anomalies, costs, checks and streams."""
