"""Training-data operators: deduplication, packing, scans, filters, sharding.

Nothing else in the library imports this subpackage.
"""
