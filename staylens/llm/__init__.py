"""Operators for preparing language-model training data.

Nothing else in the package imports this one.  Every operator takes and returns DataFrames and
selects the columns it needs by name, so extra columns never clash.
"""
