"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Executors import it too: on a cluster ship the repository with ``--py-files`` or put it on their
``PYTHONPATH``.
"""
