"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage. ``queries`` registers one query per
operator; the operators themselves take and return DataFrames and name their columns by
argument. Extra input columns are ignored, so their names never clash with results.
"""
