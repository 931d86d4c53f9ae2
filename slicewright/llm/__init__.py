"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` applies them to the shared
tables with their production parameters.
"""
