"""Composed plans: shared frames, naive forecasters, the dataset builder and
the query catalogue."""
