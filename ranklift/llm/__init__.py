"""Operators for preparing training text: scoring, extraction, filtering, dedup, packing, formatting.

Nothing outside this subpackage imports it. Each operator is a function of DataFrames in its
own module; ``queries`` holds the thin registered queries and ``oracles`` their DuckDB SQL.
"""
