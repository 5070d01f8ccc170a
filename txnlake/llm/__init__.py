"""Operators of a training-data pipeline over ``documents``, ``pages`` and
``embeddings``.

Each module holds one operator with a general interface; ``queries`` derives
the registered result tables from them. Nothing else in the library imports
this subpackage.
"""
