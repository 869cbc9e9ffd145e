"""Operators for large-scale training-data pipelines.

One module per operator; :mod:`riskframe.llm.registry` holds the registered
queries and their SQL. Nothing else in the library imports this subpackage.
"""
