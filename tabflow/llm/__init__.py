"""Operators of a training-data pipeline: mixing, sharding, scoring, filtering, joining, encoding.

Each operator names the columns it reads and returns new columns of its own, so further columns of
the input, whatever their names, never clash with its working columns.
"""
