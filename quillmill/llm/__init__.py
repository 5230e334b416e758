"""Operators for large training-data pipelines; each module states its method and its edge cases."""
