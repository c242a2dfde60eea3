"""Operators of a training-data pipeline: packing, filtering, deduplication, tokens, search.

Each module holds one operator; :mod:`wattspan.llm.registry` lists the queries that apply
them to their whole tables. Nothing else in the library imports this subpackage.
"""
