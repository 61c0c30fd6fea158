"""Corpus operators for training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
applies them to the driver tables.  Nothing outside this package imports it.
"""
