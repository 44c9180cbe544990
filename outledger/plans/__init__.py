"""Datasets as compositions of operators. ``t`` is a mapping of tables by role."""
