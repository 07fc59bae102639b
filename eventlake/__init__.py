"""Event lakehouse on Spark: raw JSON events -> bronze -> silver -> gold -> reports."""
