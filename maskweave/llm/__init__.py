"""Operators for training-data pipelines, their queries and oracle SQL.

Nothing else in the library imports this subpackage.
"""
