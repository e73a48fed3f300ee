"""Operators for training-data pipelines over the ``documents``, ``pages``,
``embeddings`` and ``benchmark`` tables. Nothing else in the library imports
this package; its queries are added in ``__spark_entry__`` when it is present.
"""
