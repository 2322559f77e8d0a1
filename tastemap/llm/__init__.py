"""Operators of a large training-data pipeline, one module each.

Nothing outside this package imports it.  Every operator selects the columns
it needs first, so extra columns of any name pass by without a clash.
"""
