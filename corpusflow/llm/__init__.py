"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` applies
them to whole tables with production parameters. Nothing outside this
subpackage imports it.
"""
