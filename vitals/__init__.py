"""vitals: wearable-health analytics as plain PySpark DataFrame jobs."""
