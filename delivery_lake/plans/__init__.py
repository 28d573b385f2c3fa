"""Composed plans: Gold build, the query catalogue, its SQL oracle and the pipeline."""
