"""Corpus operators for training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
binds them to the ``documents``, ``pages``, ``benchmark`` and ``labels``
tables.  Nothing outside this subpackage imports it.
"""
