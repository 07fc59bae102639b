"""Table, Kafka and test-feed sources."""
