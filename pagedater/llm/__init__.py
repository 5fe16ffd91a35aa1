"""Operators of a training-data pipeline, each a function from DataFrame to DataFrame.

Nothing else in the package imports this subpackage.
"""
