"""Aircraft telemetry lake on Spark: raw snapshots to quality-checked flight tables."""
