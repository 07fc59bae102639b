"""Streaming sinks, the three jobs, supervision and progress metrics."""
