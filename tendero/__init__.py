"""Retail analytics as lazy Spark DataFrame jobs.

Every operator has the shape ``f(tables, **params) -> DataFrame`` where ``tables`` maps the
six base table names (see :mod:`tendero.schemas`) to DataFrames.  Nothing is collected inside
an operator, dates are parameters, and joins carry no hints: Spark broadcasts a dimension only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a
sort-merge join (with AQE skew splitting) beyond it.
"""
