"""Operators for training-data pipelines over large text corpora.

Nothing else in the package imports from here; removing this folder leaves the
warehouse operators untouched.
"""
