"""Operators of a training-data pipeline: filtering, near duplicates, packing, web archives.

Nothing outside this folder imports it. ``queries.py`` holds the registered queries and their SQL.
"""
