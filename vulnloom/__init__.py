"""Spark engine that turns a lake of crawled advisory pages into a table.

Listing pages give an ordered id index, advisory pages give one 22-column
record each, and new records are added to the dataset in batch or as a stream.
"""
