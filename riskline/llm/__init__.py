"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own interface; ``queries`` holds the registered
queries over the driver's tables. Nothing outside this subpackage imports it.
"""
