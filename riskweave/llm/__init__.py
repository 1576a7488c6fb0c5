"""Operators of a large-scale training-data pipeline, as Spark jobs.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator. Nothing outside this subpackage imports it.
"""
