"""Operators of a training-data pipeline over `documents`-like tables.

Each module holds one operator by one named method; `queries` registers them.
Nothing else in the library imports this subpackage.
"""
