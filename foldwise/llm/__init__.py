"""Operators a training-data pipeline needs: scoring, deduplication, search, encoding.

Nothing outside this package imports it. Each module holds one operator with a general
interface; ``queries`` registers them on the tables of the driver.
"""
