"""Operators of a training-data pipeline, each with its own general interface.

Nothing else in the library imports this package.  ``layerstar.llm.registry``
holds the thin queries over the driver tables and their DuckDB SQL.
"""
