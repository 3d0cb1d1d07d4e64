"""Operators of a training-data pipeline over ``documents``, ``embeddings``,
``pages`` and ``conversations``. Nothing else in the library imports this
subpackage."""
