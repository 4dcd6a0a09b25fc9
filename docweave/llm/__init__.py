"""Operators of a large-scale training-data pipeline.

Each module holds one operator; ``queries`` holds the thin registered
queries. Nothing else in the library imports this subpackage.
"""
