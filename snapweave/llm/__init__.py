"""Operators of a training-data pipeline.

Thirteen operators, each in its own module, over tables of documents, pages, vectors and
conversations.  They import
general helpers of the library; nothing else in the library imports them.  ``workload`` holds the
registered queries with their SQL.
"""
