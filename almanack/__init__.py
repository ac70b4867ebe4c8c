"""Daily panel analytics on Spark.

The common currency is a *panel*: a DataFrame with one row per
``(series, date)`` and a ``value``.  Operators are plain functions from
DataFrame to DataFrame; nothing here runs a job unless its docstring says so.
"""
