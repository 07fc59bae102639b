"""DataFrame -> DataFrame operators, usable in batch and in streams."""
