"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; :mod:`docquarry.llm.queries` registers the thin
``opN_*`` queries over the synthetic tables.
"""
