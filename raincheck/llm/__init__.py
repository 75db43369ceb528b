"""Training-data operators: deduplication, formatting, filtering, packing.

Every module is one operator with its own DataFrame interface; ``queries``
registers one query per operator. Nothing outside this package imports it.
"""
